"""Term-matching column expressions (JVM-side, inside whole-stage codegen).

A text *mentions* a term when splitting it on the single space character gives a
token exactly equal to the term: case-sensitive, punctuation sticks to the token
("Java," is not "Java"), newline and tab are not separators, whole tokens only
("JavaScript" does not mention "Java").  A null text mentions nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_SEPARATOR = " "


def check_terms(terms: Sequence[str]) -> list[str]:
    """Validate a term list: non-empty strings, no duplicates (a duplicate would count twice)."""
    terms = list(terms)
    if not terms:
        raise ValueError("the term list is empty")
    for t in terms:
        if not isinstance(t, str) or t == "":
            raise ValueError(f"terms must be non-empty strings, got {t!r}")
    if len(set(terms)) != len(terms):
        dups = sorted({t for t in terms if terms.count(t) > 1})
        raise ValueError(f"duplicate terms: {dups}")
    return terms


def terms_array(terms: Sequence[str]) -> Column:
    """The term list as an array literal; the plan carries it, nothing is broadcast."""
    return F.array(*[F.lit(t) for t in check_terms(terms)])


def tokens(text: Column | str) -> Column:
    return F.split(F.col(text) if isinstance(text, str) else text, TOKEN_SEPARATOR)


def mentions(text: Column | str, term: str) -> Column:
    """Boolean: does ``text`` mention ``term``?  Null text gives false."""
    return F.coalesce(F.array_contains(tokens(text), F.lit(term)), F.lit(False))


def present_terms(text: Column | str, terms: Sequence[str]) -> Column:
    """The distinct listed terms the text mentions (array; null for null text).

    ``array_intersect`` hashes the term list once and walks the tokens once, and it
    de-duplicates, so an article counts once per term however often it repeats it.
    """
    return F.array_intersect(tokens(text), terms_array(terms))


def term_position(term: Column | str, terms: Sequence[str]) -> Column:
    """1-based position of the term in the list (the tie order of every ranking)."""
    return F.array_position(terms_array(terms), F.col(term) if isinstance(term, str) else term).cast("int")
