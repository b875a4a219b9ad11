"""Result checks as DataFrames: row-count expectation, two-way set difference, order check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.strict import check


def expect_row_count(df: DataFrame, expected: int | DataFrame, *, strict: bool = False) -> DataFrame:
    """One row ``(n, expected, ok)``; ``strict`` fails the job when the count differs.

    ``expected`` is a number or a table whose rows are counted in the same plan.  The count
    depends on every column (a hash rides along), so strict checks inside them do run.
    """
    spark_count = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns)).alias("seen"))
    nothing = F.lit(None).cast("bigint")
    if isinstance(expected, DataFrame):
        wanted = expected.agg(F.count(F.lit(1)).alias("expected"))
        both = (spark_count.select("n", "seen", nothing.alias("expected"))
                .unionByName(wanted.select(nothing.alias("n"), nothing.alias("seen"), "expected"))
                .agg(F.max("n").alias("n"), F.max("seen").alias("seen"), F.max("expected").alias("expected")))
    else:
        both = spark_count.withColumn("expected", F.lit(int(expected)).cast("bigint"))
    ok = (F.col("n") == F.col("expected")) & ((F.col("n") == 0) | F.col("seen").isNotNull())
    if strict:
        ok = check(ok, "row count differs from the expected one")
    return both.select("n", "expected", ok.alias("ok"))


def diff_rows(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``(side, *columns)``: rows of ``actual`` not in ``expected`` (side 'unexpected') and
    rows of ``expected`` not in ``actual`` (side 'missing'), compared as sets.

    Each side is de-duplicated first (map-side combined), so a value repeated in a
    large share of the rows reaches the anti-join once, not as a hot key.
    """
    cols = actual.columns
    a = actual.distinct()
    e = expected.select(*cols).distinct()
    unexpected = a.subtract(e).select(F.lit("unexpected").alias("side"), *cols)
    missing = e.subtract(a).select(F.lit("missing").alias("side"), *cols)
    return unexpected.unionByName(missing)


def order_violations(ranking: DataFrame, *, position_col: str = "rank", value_col: str = "n",
                     expected: DataFrame | None = None) -> DataFrame:
    """One row ``(n_rows, violations, n_diff, ok)`` for a ranking that should be descending.

    A violation is a row whose value is greater than the value at the previous
    position.  Neighbours meet through an equi-join on ``position = previous + 1``
    (a distributed shuffle join, no single-partition window).  ``n_diff`` counts the
    rows of :func:`diff_rows` against ``expected`` (0 when not given).
    """
    cur = ranking.select(F.col(position_col).alias("_pos"), F.col(value_col).alias("_v"))
    prev = ranking.select((F.col(position_col) + 1).alias("_pos"), F.col(value_col).alias("_pv"))
    rows = cur.join(prev, "_pos", "left").select(
        F.lit(True).alias("_is_row"), (F.col("_v") > F.col("_pv")).alias("_bad"))
    if expected is not None:
        diffs = diff_rows(ranking.drop(position_col), expected.drop(position_col)).select(
            F.lit(False).alias("_is_row"), F.lit(None).cast("boolean").alias("_bad"))
        rows = rows.unionByName(diffs)
    # one aggregate over rows and diffs together: no join between the three counts
    return rows.agg(
        F.count_if(F.col("_is_row")).cast("bigint").alias("n_rows"),
        F.count_if(F.col("_is_row") & F.coalesce(F.col("_bad"), F.lit(False))).cast("bigint").alias("violations"),
        F.count_if(~F.col("_is_row")).cast("bigint").alias("n_diff"),
    ).withColumn("ok", (F.col("violations") == 0) & (F.col("n_diff") == 0))
