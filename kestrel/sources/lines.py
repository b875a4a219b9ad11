"""Line-oriented text sources and sinks (one record per line).

``spark.read.text`` is a distributed scan: each executor reads its own file splits,
nothing passes through the driver.  A missing path raises at analysis time.
A custom ``line_sep`` keeps records that themselves contain newlines whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str], *, line_sep: str | None = None) -> DataFrame:
    """``(value string)``, one row per line of the text file(s) at ``path``."""
    reader = spark.read.format("text")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.load(path)


def write_lines(df: DataFrame, column: str, path: str, *, line_sep: str | None = None,
                mode: str = "errorifexists") -> str:
    """Write one string column as text lines (one file per partition, in parallel)."""
    writer = df.select(F.col(column).alias("value")).write.mode(mode).format("text")
    if line_sep is not None:
        writer = writer.option("lineSep", line_sep)
    writer.save(path)
    return path
