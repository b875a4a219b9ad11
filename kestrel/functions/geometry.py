"""2-D integer vectors: squared distance and nearest-centre assignment.

Two forms of the nearest centre, with the same result:

* :func:`nearest_centre`: the centres (a handful of ints) travel inside the plan as one array
  literal and every point is compared with each of them: a narrow projection, no join and no shuffle.
* :func:`envelopes` and :func:`envelope_segment`: for one x, a centre's squared distance is a parabola in y, and
  all these parabolas differ by straight lines only.  So the nearest centre along y is a lower
  envelope: sorted intervals of y with one centre each.  With the intervals of each distinct x in an array, a point
  needs a binary search instead of k distances; the search is a chain of plain columns inside the
  generated code.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to this absolute value of all coordinates a squared distance is exact in a double: intervals computed with
#: integers then give the very centre that comparing the distances gives.
EXACT_COORDINATE = 1 << 25
_FIRST, _NEVER = -(1 << 31), (1 << 31) - 1


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """(x1-x2)^2 + (y1-y2)^2 in double.  Deliberately *no* square root."""
    dx = x1.cast("double") - x2.cast("double")
    dy = y1.cast("double") - y2.cast("double")
    return dx * dx + dy * dy


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def centres_sql(centres: Sequence[tuple[int, int]]) -> str:
    """SQL text of the ``array<struct<i:int, cx:int, cy:int>>`` literal; ``i`` is the centre index."""
    if len(centres) == 0:
        raise ValueError("at least one centre is needed")
    return "array(" + ", ".join(
        f"named_struct('i', {i}, 'cx', {int(cx)}, 'cy', {int(cy)})" for i, (cx, cy) in enumerate(centres)) + ")"


def nearest_centre(x: str, y: str, centres: Sequence[tuple[int, int]]) -> Column:
    """Struct ``(d: double, i: int)`` of the closest centre.

    ``array_min`` over ``(distance, index)`` structs gives the smallest distance and,
    among equal distances, the lowest index.  Built as one SQL expression: one
    round trip to the JVM however many centres there are.
    """
    qx, qy = _quote(x), _quote(y)
    dist = (f"(CAST({qx} AS DOUBLE) - c.cx) * (CAST({qx} AS DOUBLE) - c.cx) + "
            f"(CAST({qy} AS DOUBLE) - c.cy) * (CAST({qy} AS DOUBLE) - c.cy)")
    return F.expr(f"array_min(transform({centres_sql(centres)}, c -> named_struct('d', {dist}, 'i', c.i)))")


def envelope_length(k: int) -> int:
    """Length of the arrays of :func:`envelopes`: the power of two from k on."""
    return 1 << max(0, k - 1).bit_length()


def envelope_arrays(xs: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first y, centre) of the intervals of each x in ``xs``, one row per x, filled up with intervals that never begin.

    Lines are added by rising cy (falling slope): a new one takes over from some y on for good, and those that it
    overtakes before they begin are taken off.  All xs are worked on at once."""
    xs, cx, cy = (np.asarray(a, dtype=np.int64) for a in (xs, cx, cy))
    begin = np.full((len(xs), envelope_length(len(cx))), _NEVER, dtype=np.int64)
    centre = np.zeros_like(begin)
    top = np.full(len(xs), -1)
    for j in np.argsort(cy, kind="stable"):
        open_ = np.arange(len(xs))
        while len(open_):
            on = top[open_]
            empty = open_[on < 0]
            begin[empty, 0], centre[empty, 0], top[empty] = _FIRST, j, 0
            open_, on = open_[on >= 0], on[on >= 0]
            i = centre[open_, on]
            x = xs[open_]
            rise = cy[j] ** 2 - cy[i] ** 2 + (x - cx[j]) ** 2 - (x - cx[i]) ** 2
            step = 2 * (cy[j] - cy[i])
            # ties go to the lower index; lines of one slope do not cross
            wins = j < i
            level = step == 0
            safe = np.where(level, 1, step)
            since = np.where(wins, -(-rise // safe), rise // safe + 1)
            since = np.where(level, np.where((rise < 0) | (rise == 0) & wins, _FIRST, _NEVER), since)
            since = np.clip(since, _FIRST, _NEVER)
            off = since <= begin[open_, on]
            stays = ~off & (since < _NEVER)
            at, new = open_[stays], on[stays] + 1
            begin[at, new], centre[at, new], top[at] = since[stays], j, new
            open_ = open_[off]
            top[open_] -= 1
            begin[open_, top[open_] + 1] = _NEVER
    return begin.astype(np.int32), centre.astype(np.int32)


def _envelope_batch(x: pa.Array, centres: Sequence[tuple[int, int]]) -> pa.RecordBatch:
    cx, cy = (np.array([c[i] for c in centres], dtype=np.int64) for i in (0, 1))
    arrays = envelope_arrays(x.to_numpy(), cx, cy)
    cuts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * arrays[0].shape[1])
    lists = [pa.ListArray.from_arrays(cuts, pa.array(a.reshape(-1))) for a in arrays]
    return pa.RecordBatch.from_arrays([x, *lists], names=["x", "begin", "centre"])


ENVELOPES = "x int, begin array<int>, centre array<int>"


def envelopes(xs: DataFrame, centres: Sequence[tuple[int, int]]) -> DataFrame:
    """ENVELOPES: the intervals of each row of ``xs`` (a table of distinct x), made where its rows are."""
    rows = max(1, (1 << 20) // envelope_length(len(centres)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield _envelope_batch(batch.column(0).slice(at, rows), centres)

    return xs.select(F.col("x").cast("int")).mapInArrow(build, ENVELOPES)


def local_envelopes(spark: SparkSession, xs: Sequence[int], centres: Sequence[tuple[int, int]]) -> DataFrame:
    """:func:`envelopes` of a few known x."""
    batch = _envelope_batch(pa.array(xs, pa.int32()), centres)
    return spark.createDataFrame(pa.Table.from_batches([batch]), ENVELOPES)


def envelope_segment(joined: DataFrame, y: str, k: int, column: str) -> DataFrame:
    """Adds ``column``, the centre of each row's y, to rows that have the ``begin`` and ``centre`` of their x."""
    out, at, step = joined, "0", envelope_length(k) >> 1
    while step:
        # a column of its own per halving: an expression that is used twice would be spelled out twice
        out = out.selectExpr("*", f"{at} + if(get(begin, {at} + {step}) <= {_quote(y)}, {step}, 0) AS _at{step}")
        at, step = f"_at{step}", step >> 1
    return out.select(*joined.columns, F.expr(f"get(centre, {at})").alias(column))
