"""Integer arithmetic with the truncating semantics the analyses need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ref(c: str | int) -> str:
    if isinstance(c, bool) or not isinstance(c, (str, int)):
        raise TypeError("int_div takes column names or int literals")
    return str(int(c)) if isinstance(c, int) else "`" + c.replace("`", "``") + "`"


def int_div(a: str | int, b: str | int) -> Column:
    """``a div b``: exact 64-bit integral division truncating toward zero (SQL ``div``).

    Takes column *names* (or int literals) because PySpark has no ``div`` function;
    64-bit exactness matters for sums of coordinates that exceed 2**53.
    """
    return F.expr(f"{_ref(a)} div {_ref(b)}")
