"""Aggregates over an int column with the list semantics of the original exercises."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.strict import required


def sum_or_zero(df: DataFrame, col: str = "v") -> DataFrame:
    """One row ``(total bigint)``: the sum, 0 on empty input."""
    return df.agg(F.coalesce(F.sum(F.col(col).cast("bigint")), F.lit(0).cast("bigint")).alias("total"))


def strict_max(df: DataFrame, col: str = "v") -> DataFrame:
    """One row ``(max_v)``: the maximum; the job fails on empty input (or all nulls)."""
    return df.agg(required(F.max(col), "max of an empty column").alias("max_v"))
