"""Integer-mean k-means (Lloyd iterations) over ``(id, x, y)`` int vectors.

Semantics: a point goes to the nearest centre by squared distance, ties to the
lowest index; a new centre is the per-cluster mean with 64-bit sums and integer
division truncating toward zero; a centre without points keeps its old value; the
loop stops when the summed squared move of all centres is < ``eta`` or after
``max_iter`` steps, returning the means of the last step.

Execution.  A point's cluster depends only on its coordinates, so the loop runs on
the *weighted distinct points* ``(x, y, w)``: one map-side-combined aggregation of
the vectors, written once to the shared checkpoint folder
(:class:`kestrel.session.Scratch`).  Means over weighted points are exactly the
means over all points (``sum(x*w) div sum(w)``).  :class:`LloydPoints` deals them over all
cores, caches them, and holds the table of their distinct x.  Each step is one job: the lower
envelope of the k parabolas per distinct x (a small table), an equi-join of the points with it on x,
a binary search per point (:mod:`kestrel.functions.geometry`), a partial+final aggregate on the cluster
index, and a collect of at most k rows.  The plan is rebuilt from the same base every step, so it does
not grow with the iteration count; its text does not grow with k.

:func:`assign_nearest` takes the centres as an array literal up to ``LITERAL_CENTRES``.  Beyond, and
wherever the envelopes would not fit, :func:`assign_by_cells` joins points and centres by the cells of
a grid.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.constants import DEFAULT_ETA, DEFAULT_MAX_ITER
from kestrel.functions.arith import int_div
from kestrel.functions.geometry import (EXACT_COORDINATE, envelope_length, envelope_segment, envelopes, local_envelopes,
                                        nearest_centre, squared_distance)
from kestrel.session import Scratch, materialize

Centre = tuple[int, int]

CENTRE_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("x", T.IntegerType(), False),
    T.StructField("y", T.IntegerType(), False),
])

TRACE_SCHEMA = T.StructType([
    T.StructField("iter", T.IntegerType(), False),
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("old_x", T.IntegerType(), False),
    T.StructField("old_y", T.IntegerType(), False),
    T.StructField("new_x", T.IntegerType(), False),
    T.StructField("new_y", T.IntegerType(), False),
    T.StructField("dist", T.DoubleType(), False),
    T.StructField("displacement", T.DoubleType(), False),
    T.StructField("converged", T.BooleanType(), False),
])


#: Most centres that travel as an array literal; more of them meet the points by grid cells.
LITERAL_CENTRES = 256
#: Points per task of a step: few enough for all cores, at most MOST_POINTS where there are plenty.
TASK_POINTS, MOST_POINTS = 8_192, 1_000_000
#: Most intervals (of all distinct x) that a step makes, and that it broadcasts (8 bytes each).
ENVELOPE_ENTRIES, SENT_ENTRIES = 1 << 27, 1 << 20
#: Up to so many distinct x the driver makes their intervals, else the tasks that hold them do.
FEW_X = 1_000
#: Centres per cell of the grid, on the average over all cells.
CELL_CENTRES = 2


def assign_nearest(vectors: DataFrame, centres: Sequence[Centre], *, x: str = "x", y: str = "y") -> DataFrame:
    """Adds ``cluster`` (nearest centre index, ties to the lowest) and ``dist`` (its squared distance).

    A null coordinate has no distance: such a row goes to centre 0 with a null ``dist``."""
    if len(centres) > LITERAL_CENTRES:
        return assign_by_cells(vectors, centres_frame(vectors.sparkSession, centres), x=x, y=y)
    return vectors.withColumn("_best", nearest_centre(x, y, centres)).select(
        *vectors.columns, F.col("_best.i").alias("cluster"), F.col("_best.d").alias("dist"))


def distance_to(vectors: DataFrame, centre: Centre, *, x: str = "x", y: str = "y") -> DataFrame:
    """Adds ``dist``: squared distance of every vector to one fixed point."""
    cx, cy = centre
    return vectors.withColumn("dist", squared_distance(F.col(x), F.col(y), F.lit(int(cx)), F.lit(int(cy))))


def weighted_points(vectors: DataFrame, *, x: str = "x", y: str = "y") -> DataFrame:
    """``(x, y, w)``: distinct points and their multiplicity (partial+final aggregate)."""
    return vectors.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("w"))


def average_vectors(vectors: DataFrame, group_cols: Sequence[str], *, x: str = "x", y: str = "y",
                    weight: str | None = None) -> DataFrame:
    """``(*group_cols, x, y, n)``: integer component-wise mean of each group.

    With ``weight``, each row stands for ``weight`` equal points.
    """
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    sums = vectors.groupBy(*group_cols).agg(
        F.sum(F.col(x).cast("bigint") * w).alias("_sx"), F.sum(F.col(y).cast("bigint") * w).alias("_sy"),
        F.sum(w).alias("n"))
    return sums.select(*group_cols, int_div("_sx", "n").cast("int").alias(x),
                       int_div("_sy", "n").cast("int").alias(y), F.col("n").cast("bigint").alias("n"))


def cluster_means(points: DataFrame, centres: Sequence[Centre], *, weight: str | None = None) -> DataFrame:
    """``(cluster, x, y, n)`` for every centre that has points."""
    cols = ["x", "y"] + ([weight] if weight else [])
    return average_vectors(assign_nearest(points.select(*cols), centres), ["cluster"], weight=weight)


def _new_centres(means: DataFrame, centres: Sequence[Centre]) -> list[Centre]:
    found = {int(r["cluster"]): (int(r["x"]), int(r["y"])) for r in means.collect()}
    return [found.get(i, c) for i, c in enumerate(centres)]


def lloyd_step(points: DataFrame, centres: Sequence[Centre], *, weight: str | None = None) -> list[Centre]:
    """One step over any points: new centres (k rows come back); an empty cluster keeps its old centre."""
    return _new_centres(cluster_means(points, centres, weight=weight), centres)


class LloydPoints:
    """Weighted points ``(x, y, w)`` made ready for many steps; a context manager that lets go of the cache.

    ``base`` should be a written table: a lost executor's cached partitions are computed from it again."""

    def __init__(self, base: DataFrame, scratch: Scratch):
        reach = F.greatest(*(F.abs(F.col(c).cast("long")) for c in ("x", "low", "high")))
        xs = base.groupBy("x").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isNull() | F.col("y").isNull()).alias("nulls"),
            F.min("y").alias("low"), F.max("y").alias("high")).select("x", "n", "nulls", reach.alias("reach"))
        few = xs.limit(FEW_X + 1).collect()  # FEW_X + 1 rows at most
        if len(few) <= FEW_X:
            self.own, self.xs, self.distinct = [r["x"] for r in few], None, len(few)
            rows, nulls, most = sum(r["n"] for r in few), sum(r["nulls"] for r in few), max((r["reach"] or 0 for r in few), default=0)
        else:
            xs = scratch.materialize(xs, "kmeans-xs")
            rows, nulls, self.distinct, most = xs.agg(F.sum("n"), F.sum("nulls"), F.count(F.lit(1)), F.max("reach")).first()
            self.own, self.xs = None, xs.select("x")
        self.rows, self.exact = rows, not nulls and (most or 0) <= EXACT_COORDINATE
        cores = base.sparkSession.sparkContext.defaultParallelism
        self.partitions = max(1, min(math.ceil(self.rows / TASK_POINTS), max(cores, math.ceil(self.rows / MOST_POINTS))))
        self.points = base.select("x", "y", "w").repartition(self.partitions, "x", "y").persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> LloydPoints:
        return self

    def __exit__(self, *exc) -> None:
        self.points.unpersist()

    def assigned(self, centres: Sequence[Centre]) -> DataFrame:
        """``(x, y, w, cluster)``: the points with their nearest centres."""
        k = len(centres)
        intervals = self.distinct * envelope_length(k)
        reach = max((abs(c) for centre in centres for c in centre), default=0)
        if not self.rows or not self.exact or reach > EXACT_COORDINATE or intervals > ENVELOPE_ENTRIES:
            return assign_nearest(self.points, centres).drop("dist")
        if self.own is None:
            table = envelopes(self.xs, centres)
        else:
            table = local_envelopes(self.points.sparkSession, self.own, centres)
        # at most SENT_ENTRIES * 8 bytes are broadcast
        table = F.broadcast(table) if intervals <= SENT_ENTRIES else table.hint("merge")
        return envelope_segment(self.points.join(table, "x"), "y", k, "cluster").drop("begin", "centre")

    def step(self, centres: Sequence[Centre]) -> list[Centre]:
        """One Lloyd step, as :func:`lloyd_step`."""
        return _new_centres(average_vectors(self.assigned(centres), ["cluster"], weight="w"), centres)


# ------------------------------------------------------------------ many centres: cells of a grid

def _grid(centres: DataFrame) -> dict[str, float] | None:
    """Origin, cell sides and number of cells per axis: about ``CELL_CENTRES`` centres per cell of their bounding box."""
    n, x0, x1, y0, y1 = centres.agg(F.count(F.lit(1)), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if not n:
        raise ValueError("at least one centre is needed")
    wide, high, cells = float(x1) - x0, float(y1) - y0, max(1, n // CELL_CENTRES)
    if not wide or not high:  # on a line
        nx, ny = (cells if wide else 1), (cells if high else 1)
    else:  # square cells as far as that goes
        nx = min(cells, max(1, round(math.sqrt(cells * wide / high))))
        ny = max(1, cells // nx)
    return {"x0": x0, "y0": y0, "nx": nx, "ny": ny, "sx": (wide / nx) or 1.0, "sy": (high / ny) or 1.0}


def _cell(grid: dict[str, float], x: str, y: str) -> list:
    """The grid cell of a point; points outside the box belong to the cells at its edge."""
    def along(c: str, o: float, side: float, n: int):
        at = F.floor((F.col(c).cast("double") - F.lit(float(o))) / F.lit(side))
        return F.least(F.greatest(at, F.lit(0)), F.lit(n - 1)).cast("int")
    return [along(x, grid["x0"], grid["sx"], grid["nx"]).alias("_gx"), along(y, grid["y0"], grid["sy"], grid["ny"]).alias("_gy")]


def _way_out(cell: str, low: str, high: str, origin: float, side: float, cells: int, radius: int) -> Column:
    """From a cell's box to the edge of its ring along one axis; behind the grid's own edge there is no centre."""
    at, origin, side = F.col(cell), F.lit(float(origin)), F.lit(side)
    before = F.when(at - radius <= 0, F.lit(math.inf)).otherwise(F.col(low) - (origin + (at - radius) * side))
    behind = F.when(at + radius >= cells - 1, F.lit(math.inf)).otherwise(origin + (at + radius + 1) * side - F.col(high))
    return F.least(before, behind)


def cell_candidates(points: DataFrame, centres: DataFrame, grid: dict[str, float]) -> DataFrame:
    """``(_gx, _gy, near array<struct<i, cx, cy>>)``: per cell that holds points (``_gx, _gy, _x, _y``) the centres that
    may be the nearest of one of them.

    Of a cell only the box around its points counts.  A centre whose largest distance to the box is u bounds
    all; the ring of cells up to radius r around the cell is enough once u is smaller than the way out of
    the ring.  The radius doubles for the cells where it is not yet, and a ring over the whole grid always is.
    Every round is an equi-join of ring cells with the centres' cells."""
    box = materialize(points.groupBy("_gx", "_gy").agg(
        F.min("_x").alias("l"), F.max("_x").alias("r"), F.min("_y").alias("b"), F.max("_y").alias("t")), "cells")
    own = materialize(centres.select(F.col("cluster").alias("i"), F.col("x").alias("cx"), F.col("y").alias("cy"),
                                     *_cell(grid, "x", "y")), "centre-cells")
    own = own.withColumnsRenamed({"_gx": "_hx", "_gy": "_hy"})
    x, y = F.col("cx").cast("double"), F.col("cy").cast("double")
    far_x, far_y = F.greatest(F.abs(x - F.col("l")), F.abs(x - F.col("r"))), F.greatest(F.abs(y - F.col("b")), F.abs(y - F.col("t")))
    near_x, near_y = (F.greatest(F.col(a) - c, c - F.col(z), F.lit(0.0)) for c, a, z in ((x, "l", "r"), (y, "b", "t")))
    rounding = 1 + 1e-9  # far more than the distances lose: a candidate too many does no harm
    nx, ny, radius, out = grid["nx"], grid["ny"], 1, None
    while True:
        gap = F.least(_way_out("_gx", "l", "r", grid["x0"], grid["sx"], nx, radius),
                      _way_out("_gy", "b", "t", grid["y0"], grid["sy"], ny, radius))
        ring = box.withColumn("gap", gap).withColumn("_hx", F.explode(F.sequence(
            F.greatest(F.col("_gx") - radius, F.lit(0)), F.least(F.col("_gx") + radius, F.lit(nx - 1)))))
        ring = ring.withColumn("_hy", F.explode(F.sequence(
            F.greatest(F.col("_gy") - radius, F.lit(0)), F.least(F.col("_gy") + radius, F.lit(ny - 1)))))
        met = ring.join(own, ["_hx", "_hy"]).withColumn("u", far_x * far_x + far_y * far_y).withColumn(
            "d", near_x * near_x + near_y * near_y)
        bound = met.groupBy("_gx", "_gy").agg(F.min("u").alias("least"))
        safe = F.col("gap") / rounding
        judged = box.withColumn("gap", gap).join(bound, ["_gx", "_gy"], "left").withColumn(
            "done", F.coalesce((F.col("gap") > 0) & (F.col("least") < safe * safe), F.lit(False)))
        judged = materialize(judged, "cell-bounds")
        done = judged.filter("done").select("_gx", "_gy", "least")
        near = (met.join(done, ["_gx", "_gy"]).filter(F.col("d") <= F.col("least") * rounding + 1e-9)
                .groupBy("_gx", "_gy").agg(F.collect_list(F.struct("i", "cx", "cy")).alias("near")))
        out = near if out is None else out.unionByName(near)
        if radius >= max(nx, ny):
            return out
        box = judged.filter("not done").select("_gx", "_gy", "l", "r", "b", "t")
        if box.isEmpty():
            return out
        radius *= 2


def assign_by_cells(vectors: DataFrame, centres: DataFrame, *, x: str = "x", y: str = "y") -> DataFrame:
    """:func:`assign_nearest` for any number of centres, given as a table ``(cluster, x, y)``.

    Points and candidates meet in an equi-join on the cell, then each point is compared with its cell's few
    candidates.  No cross join, no collect, and the plan does not grow with the centres."""
    grid = _grid(centres)
    keyed = vectors.select("*", *_cell(grid, x, y))
    spots = keyed.select("_gx", "_gy", F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    near = cell_candidates(spots.filter("_x is not null and _y is not null"), centres, grid)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    best = F.array_min(F.transform("near", lambda c: F.struct(
        ((px - c.cx) * (px - c.cx) + (py - c.cy) * (py - c.cy)).alias("d"), c.i.alias("i"))))
    joined = keyed.join(near, ["_gx", "_gy"], "left").withColumn("_best", best)
    return joined.select(*vectors.columns, F.coalesce("_best.i", F.lit(0)).cast("int").alias("cluster"),
                         F.col("_best.d").alias("dist"))


def point_distance(a: Centre, b: Centre) -> float:
    return float((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2)


def center_displacement(old: Sequence[Centre], new: Sequence[Centre]) -> float:
    """Sum of squared moves; both lists must have the same length."""
    if len(old) != len(new):
        raise ValueError(f"centre lists differ in length: {len(old)} vs {len(new)}")
    return float(sum(point_distance(a, b) for a, b in zip(old, new)))


def converged(displacement: float, eta: float = DEFAULT_ETA) -> bool:
    return displacement < eta


@dataclass
class KMeansResult:
    centres: list[Centre]
    iterations: int
    displacement: float
    converged: bool
    #: Per step the old and the new centres (k x 4 integers), the displacement and whether it stops there.
    steps: list[tuple[np.ndarray, float, bool]] = field(default_factory=list)

    @property
    def trace(self) -> list[tuple]:
        """TRACE_SCHEMA rows."""
        return [tuple(r.values()) for r in self.trace_table().to_pylist()]

    def trace_table(self) -> pa.Table:
        k = len(self.centres)
        moves = np.concatenate([m for m, _, _ in self.steps]) if self.steps else np.empty((0, 4), np.int64)
        ox, oy, nx, ny = moves.T
        of_step = [np.repeat(np.array(c, dtype=t), k) for c, t in (
            (range(1, len(self.steps) + 1), np.int32), ([d for _, d, _ in self.steps], np.float64),
            ([e for _, _, e in self.steps], bool))]
        dist = (ox - nx).astype(float) ** 2 + (oy - ny).astype(float) ** 2
        columns = [of_step[0], np.tile(np.arange(k, dtype=np.int32), len(self.steps)), *(c.astype(np.int32) for c in moves.T),
                   dist, *of_step[1:]]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=TRACE_SCHEMA.names)


def kmeans(vectors: DataFrame, centres: Sequence[Centre], *, eta: float = DEFAULT_ETA,
           max_iter: int = DEFAULT_MAX_ITER, weighted: DataFrame | None = None) -> KMeansResult:
    """Iterate :func:`lloyd_step` until :func:`converged` or ``max_iter`` steps.

    ``weighted`` may pass an already materialised :func:`weighted_points` table.
    """
    with Scratch(vectors.sparkSession) as scratch:
        base = scratch.materialize(weighted_points(vectors), "kmeans-points") if weighted is None else weighted
        with LloydPoints(base, scratch) as points:  # cached only inside the loop
            return kmeans_of(points, centres, eta=eta, max_iter=max_iter)


def kmeans_of(points: LloydPoints, centres: Sequence[Centre], *, eta: float = DEFAULT_ETA,
              max_iter: int = DEFAULT_MAX_ITER) -> KMeansResult:
    """:func:`kmeans` over points that are ready for the steps."""
    if max_iter < 1:
        raise ValueError("max_iter must be >= 1")
    centres = [(int(cx), int(cy)) for cx, cy in centres]
    steps: list[tuple[np.ndarray, float, bool]] = []
    while True:
        new = points.step(centres)
        disp = center_displacement(centres, new)
        done = converged(disp, eta)
        steps.append((np.array([(*o, *n) for o, n in zip(centres, new)], dtype=np.int64).reshape(-1, 4), disp, done))
        centres = new
        if done or len(steps) >= max_iter:
            return KMeansResult(centres, len(steps), disp, done, steps)


def centres_frame(spark: SparkSession, centres: Sequence[Centre]) -> DataFrame:
    """``(cluster, x, y)``: k rows."""
    x, y = (np.array([c[i] for c in centres], dtype=np.int32) for i in (0, 1))
    table = pa.Table.from_arrays([pa.array(a) for a in (np.arange(len(x), dtype=np.int32), x, y)], names=CENTRE_SCHEMA.names)
    return spark.createDataFrame(table, CENTRE_SCHEMA)


def trace_frame(spark: SparkSession, result: KMeansResult) -> DataFrame:
    """``(iter, cluster, old_x, old_y, new_x, new_y, dist, displacement, converged)``."""
    return spark.createDataFrame(result.trace_table(), TRACE_SCHEMA)
