"""Per-cluster statistics and the text report.

Every statistic is computed from counts ``(cluster, x, y, cnt)`` -- bounded by
clusters x categories x distinct scores, not by the number of points.  The
report takes them from the weighted distinct points (:func:`weighted_points`,
one map-side-combined pass over the vectors); the standalone operators count a
membership table the same way.  No cluster is ever gathered into one task: the dominant
category comes from per-category counts, the median from two rounds of range narrowing
(:func:`_median`), each of which sees at most 65,536 rows per cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.constants import REPORT_HEADER, REPORT_ROW_FORMAT
from kestrel.functions.categories import category_label
from kestrel.operators.kmeans import Centre, assign_nearest, weighted_points


def cluster_membership(vectors: DataFrame, centres: Sequence[Centre], *, id_col: str = "question_id") -> DataFrame:
    """``(id, cluster, x, y)``: every point with its final cluster (flat, never grouped).

    A narrow projection at every size: no shuffle, no lookup, no row lost.
    """
    return assign_nearest(vectors, centres).select(id_col, "cluster", "x", "y")


def _point_counts(membership: DataFrame) -> DataFrame:
    return membership.groupBy("cluster", "x", "y").agg(F.count(F.lit(1)).alias("cnt"))


def cluster_size(membership: DataFrame) -> DataFrame:
    """``(cluster, size)`` for every non-empty cluster."""
    return membership.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def _dominant(counts: DataFrame, categories: Sequence[str], spread: int) -> DataFrame:
    per_x = counts.groupBy("cluster", "x").agg(F.sum("cnt").alias("n"))
    # most frequent x, among equally frequent ones the lowest x (a null one last): the largest of one number per x, so
    # that the buffer has a fixed width and nothing is sorted
    turn = F.coalesce(F.lit(1 << 31) - F.col("x").cast("bigint"), F.lit(0).cast("bigint"))
    number = F.col("n").cast("decimal(19,0)") * F.lit(1 << 33).cast("decimal(10,0)") + turn.cast("decimal(19,0)")
    agg = per_x.groupBy("cluster").agg(F.max(number).alias("best"), F.max("n").alias("dominant_n"), F.sum("n").alias("size"))
    turned = (F.col("best") % F.lit(1 << 33)).cast("bigint")
    agg = agg.withColumn("dominant_x", F.when(turned > 0, F.lit(1 << 31) - turned).cast("int"))
    return agg.select(
        "cluster", "dominant_x", category_label("dominant_x", categories, spread).alias("label"),
        F.col("dominant_n").cast("bigint").alias("dominant_n"), F.col("size").cast("bigint").alias("size"),
        # integer percentage, then widened (the original divides ints)
        F.expr("CAST((`dominant_n` * 100) div `size` AS DOUBLE)").alias("percent"))


def cluster_dominant(membership: DataFrame, categories: Sequence[str], spread: int) -> DataFrame:
    """``(cluster, label, dominant_n, size, percent)``."""
    return _dominant(_point_counts(membership), categories, spread).select(
        "cluster", "label", "dominant_n", "size", "percent")


def _median(counts: DataFrame) -> DataFrame:
    """``(cluster, median_score)`` of ``(cluster, y int, cnt)``: the middle y, or the mean of the two middle ones
    truncated toward zero.

    A selection by value ranges: the high 16 bits of y bin the values (at most 65,536 bins per cluster, combined
    map-side); running sums over the bins say where the middle ranks lie.  Only the values of those one or
    two bins per cluster (at most 65,536 each) are then counted one by one.  No buffer and no window grows with
    the distinct values of a cluster."""
    y = F.col("y").cast("int")
    # nulls count for nothing, in a bin of their own: a cluster without any value keeps its row
    rows = counts.select("cluster", y.alias("y"), F.coalesce(F.shiftright(y, 16), F.lit(1 << 16)).alias("bin"),
                         F.when(F.col("y").isNotNull(), F.col("cnt")).otherwise(0).cast("bigint").alias("cnt"))
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")

    def holds(rank):
        return (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))

    bins = rows.groupBy("cluster", "bin").agg(F.sum("cnt").alias("n"))
    whole = Window.partitionBy("cluster")
    bins = (bins.withColumn("total", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(whole.orderBy("bin")))
            .withColumn("lo", low).withColumn("hi", high))
    picked = bins.where(holds(F.col("lo")) | holds(F.col("hi")) | (F.col("total") == 0)).select(
        "cluster", "bin", "lo", "hi", (F.col("upto") - F.col("n")).alias("before"))
    values = rows.join(picked, ["cluster", "bin"])
    values = values.groupBy("cluster", "bin", "lo", "hi", "before", "y").agg(F.sum("cnt").alias("n"))
    values = values.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("cluster", "bin").orderBy("y")))
    middle = values.groupBy("cluster").agg(F.max(F.when(holds(F.col("lo")), F.col("y"))).cast("bigint").alias("lower"),
                                           F.max(F.when(holds(F.col("hi")), F.col("y"))).cast("bigint").alias("upper"))
    return middle.select("cluster", F.expr("(lower + upper) div 2").cast("int").alias("median_score"))


def cluster_median(membership: DataFrame) -> DataFrame:
    """``(cluster, median_score)``."""
    return _median(_point_counts(membership))


def cluster_results(vectors: DataFrame, centres: Sequence[Centre], categories: Sequence[str],
                    spread: int, *, weighted: DataFrame | None = None, assigned: DataFrame | None = None) -> DataFrame:
    """Per non-empty cluster ``(cluster, label, percent, size, median_score)``, by median.

    ``weighted`` may pass an already materialised :func:`weighted_points` table, ``assigned`` one of these points
    with their clusters ``(x, y, w, cluster)``."""
    if assigned is None:
        points = weighted if weighted is not None else weighted_points(vectors)
        assigned = assign_nearest(points.select("x", "y", "w"), centres)
    counts = assigned.select("cluster", "x", "y", F.col("w").alias("cnt"))
    dom = _dominant(counts, categories, spread)
    med = _median(counts)
    # both sides have at most k rows
    return (dom.join(med, "cluster")
            .select("cluster", "label", "percent", "size", "median_score")
            .orderBy("median_score", "label", "cluster"))


def cluster_report_lines(results: DataFrame) -> DataFrame:
    """``(line_no, line)``: header, then one fixed-width line per cluster in report order."""
    spark = results.sparkSession
    header = spark.createDataFrame([(i, h) for i, h in enumerate(REPORT_HEADER)], "line_no int, line string")
    # at most k rows: a single-partition window is fine here
    w = Window.orderBy("median_score", "label", "cluster")
    body = results.select(
        (F.row_number().over(w) + F.lit(len(REPORT_HEADER) - 1)).cast("int").alias("line_no"),
        F.format_string(REPORT_ROW_FORMAT, "median_score", "label", "percent", "size").alias("line"))
    return header.unionByName(body).orderBy("line_no")
