"""Helpers shared by the operators: whitespace words, Arrow batches, settings."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the contracts: space and \x09-\x0D.  ``bytes.split()`` splits on the same six bytes.
SPACE = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"


def words_column(text: Column) -> Column:
    """Words (runs of anything but ASCII white space) of a text; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != F.lit(""))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of text that Spark hands to a Python task at once: rows have no bound of their own.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches no larger than BATCH_BYTES (a single longer row is a batch)."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(setting)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(setting, BATCH_BYTES)


def per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """One object per Python worker process: tasks that run in a reused worker share it."""
    store = sys.modules.setdefault("_kestrel_worker", types.ModuleType("_kestrel_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
