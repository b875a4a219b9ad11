"""Term-ranking pipeline: raw article lines -> articles -> the three rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.constants import DEFAULT_TERMS
from kestrel.operators.ranking import (explode_term_sets, matched_term_sets, rank_terms_from_index,
                                       rank_terms_from_sets, rank_terms_single_pass_from_sets)
from kestrel.session import materialize
from kestrel.sources.articles import parse_article_lines


def term_ranking_pipeline(lines: DataFrame, terms: Sequence[str] = DEFAULT_TERMS, *,
                          line_col: str = "value", on_error: str = "raise") -> DataFrame:
    """``(method, rank, term, n)``: the complete, index-based and one-pass rankings.

    The three agree on every term that occurs; only the complete and one-pass ones
    list terms with a zero count.  The text is read and tokenised once: the matched
    term set of every article (a short array, far smaller than the text) is written
    to the shared checkpoint folder and the three rankings start from it.
    """
    articles = parse_article_lines(lines, line_col, on_error=on_error)
    # only the sets are kept (no titles): the rankings never read the article id
    sets = materialize(matched_term_sets(articles, terms).select("matched"), "term-sets")
    complete = rank_terms_from_sets(sets, terms)
    from_index = rank_terms_from_index(explode_term_sets(sets, id_col=None), terms)
    single = rank_terms_single_pass_from_sets(sets, terms)
    return (complete.select(F.lit("complete").alias("method"), "*")
            .unionByName(from_index.select(F.lit("index").alias("method"), "*"))
            .unionByName(single.select(F.lit("single_pass").alias("method"), "*")))
