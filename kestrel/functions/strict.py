"""Fail-fast helpers: a value the analysis cannot do without raises instead of vanishing.

``raise_error`` only fires if its column is evaluated, so these helpers are meant to
be used in a key or value the result depends on (a pruned column is never computed).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(value: Column, message: str) -> Column:
    """``value``, or a task failure with ``message`` where it is null.

    ``raise_error`` is typed NULL, so ``coalesce`` keeps the type of ``value``.
    """
    return F.coalesce(value, F.raise_error(F.lit(message)))


def check(condition: Column, message: str) -> Column:
    """True where ``condition`` holds, a task failure otherwise (null counts as failure)."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.lit(message)))
