"""In-memory rows -> DataFrame, with an explicit schema (no inference).

Only for small literal inputs (tests, parameters): the rows are shipped from the
driver, so this is not a way to load data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema=schema)


def local_articles(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    """``(title, text)`` articles from literal pairs."""
    return local_rows(spark, rows, ARTICLE_SCHEMA)
