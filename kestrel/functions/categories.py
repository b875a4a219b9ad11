"""Category (tag) <-> vector-coordinate expressions.

A question's category is the 0-based position of its tag in the category list;
its x coordinate is ``index * spread``.  ``x div spread`` recovers the index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kestrel.functions.arith import int_div
from kestrel.functions.strict import required
from kestrel.functions.text import check_terms


def categories_array(categories: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in check_terms(categories)])


def category_index(tag: Column | str, categories: Sequence[str]) -> Column:
    """0-based index of the first list entry equal to ``tag``; null if missing or unknown."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    # array_position: 1-based, 0 when absent, null when tag is null
    return (F.nullif(F.array_position(categories_array(categories), tag), F.lit(0)) - 1).cast("int")


def category_x(tag: Column | str, categories: Sequence[str], spread: int, *, strict: bool = True) -> Column:
    """x coordinate of a tag: ``index * spread``; a missing/unknown tag raises when strict."""
    check_reach(categories, spread)
    idx = category_index(tag, categories)
    if strict:
        idx = required(idx, "question tag is missing or not in the category list")
    return (idx * F.lit(spread)).cast("int")


def tag_code(tag: str, categories: Sequence[str]) -> Column:
    """A small integer in the order of the tags themselves: 0 for null, else even for a listed tag, odd between two of them.

    Two different unknown tags may share a code; listed ones never do."""
    known = sorted(check_terms(categories))
    listed = F.array(*[F.lit(c) for c in known])
    below = F.size(F.filter(listed, lambda c: c < F.col(tag)))
    place = F.nullif(F.array_position(listed, F.col(tag)), F.lit(0))
    return F.when(F.col(tag).isNull(), 0).otherwise(F.coalesce(2 * place, 2 * below + 1)).cast("int")


def category_x_of_code(code: Column, categories: Sequence[str], spread: int, *, strict: bool = True) -> Column:
    """:func:`category_x` from a :func:`tag_code`."""
    check_reach(categories, spread)
    xs = [list(categories).index(c) * spread for c in sorted(categories)]
    x = F.when((code > 0) & (code % 2 == 0), F.get(F.array(*[F.lit(v) for v in xs]), (code / 2).cast("int") - 1))
    if strict:
        x = required(x, "question tag is missing or not in the category list")
    return x.cast("int")


def category_label(x: str, categories: Sequence[str], spread: int) -> Column:
    """Inverse of :func:`category_x`: ``categories[x div spread]`` (null when out of range)."""
    check_spread(spread)
    return F.get(categories_array(categories), int_div(x, spread).cast("int"))


def check_reach(categories: Sequence[str], spread: int) -> None:
    check_spread(spread)
    if spread * (len(categories) - 1) > 2**31 - 1:
        raise ValueError(f"spread {spread} x {len(categories) - 1} categories does not fit the int x coordinate")


def check_spread(spread: int) -> None:
    if not isinstance(spread, int) or spread <= 0:
        raise ValueError("spread must be a positive int, or the category cannot be recovered from x")
