"""Term ranking over articles: how many articles mention each listed term.

Every variant scans the text once, and all of them can start from the same
:func:`matched_term_sets` (the term-ranking pipeline computes it once for the
three).  Articles are never grouped or shuffled whole:
what crosses the network is (term, partial count) pairs after map-side combine,
at most ``len(terms)`` per task, so a term that occurs in a third of all articles
costs no more than a rare one.

Ranked outputs are ``(rank int, term string, n bigint)``: ``n`` descending, ties in
term-list order.  The variants differ on terms no article mentions:

* :func:`rank_terms` - every listed term, zeros included, even on empty input;
* :func:`rank_terms_from_index` - only terms that occur;
* :func:`rank_terms_single_pass` - every term when the input has rows, nothing otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.parts import dealt_part
from kestrel.functions.text import check_terms, mentions, present_terms, term_position, terms_array
from kestrel.session import materialize


def mentions_term(articles: DataFrame, term: str, *, text_col: str = "text",
                  keep: Sequence[str] = ("title",)) -> DataFrame:
    """``(*keep, mentions boolean)`` per article."""
    return articles.select(*keep, mentions(text_col, term).alias("mentions"))


def occurrences_of_term(articles: DataFrame, term: str, *, text_col: str = "text") -> DataFrame:
    """One row ``(term, n)``: articles mentioning ``term`` (0 on empty input).

    A global aggregate: one partial count per task, one tiny final merge.
    """
    return articles.agg(F.count_if(mentions(text_col, term)).alias("n")).select(
        F.lit(term).alias("term"), F.col("n").cast("bigint").alias("n"))


def matched_term_sets(articles: DataFrame, terms: Sequence[str], *, id_col: str = "title",
                      text_col: str = "text") -> DataFrame:
    """``(id, matched array<string>)``: the distinct listed terms each article mentions.

    The only step that reads and tokenises the text; every ranking below can start
    from it.  Null text gives a null set (mentions nothing).
    """
    return articles.select(F.col(id_col), present_terms(text_col, terms).alias("matched"))


def explode_present_terms(articles: DataFrame, terms: Sequence[str], *, id_col: str = "title",
                          text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``(id, term[, text])``: one row per (article, listed term it mentions)."""
    if keep_text:
        return articles.select(F.col(id_col), F.col(text_col),
                               F.explode(present_terms(text_col, terms)).alias("term")).select(
            id_col, "term", text_col)
    return explode_term_sets(matched_term_sets(articles, terms, id_col=id_col, text_col=text_col), id_col=id_col)


def _matched_terms(sets: DataFrame, *cols) -> DataFrame:
    """``(*cols, term)``: one row per matched term (articles without a match give none).

    ``explode_outer`` + a null filter on the generated column, not ``explode``: for an
    inner explode Catalyst infers ``size(matched) > 0`` and pushes it below the
    projection that computes ``matched``, which would tokenise every text twice.
    """
    return sets.select(*cols, F.explode_outer("matched").alias("term")).where(F.col("term").isNotNull())


def explode_term_sets(sets: DataFrame, *, id_col: str | None = "title") -> DataFrame:
    """``(id, term)`` from :func:`matched_term_sets` (just ``(term)`` with ``id_col=None``)."""
    return _matched_terms(sets, *([F.col(id_col)] if id_col else []))


def term_indicator(articles: DataFrame, terms: Sequence[str], *, id_col: str = "title",
                   text_col: str = "text") -> DataFrame:
    """``(id, term, hit int)``: one row per (article, listed term), hit 1 or 0."""
    return indicator_from_sets(matched_term_sets(articles, terms, id_col=id_col, text_col=text_col), terms,
                               id_col=id_col)


def indicator_from_sets(sets: DataFrame, terms: Sequence[str], *, id_col: str = "title") -> DataFrame:
    """``(id, term, hit)`` from :func:`matched_term_sets`.

    The matched set is computed once per article (a Project below the Generate);
    each term then probes that small array, never the token list.
    """
    terms = check_terms(terms)
    pairs = F.transform(terms_array(terms), lambda t: F.struct(
        t.alias("term"),
        F.coalesce(F.array_contains(F.col("matched"), t), F.lit(False)).cast("int").alias("hit")))
    return sets.select(F.col(id_col), F.inline(pairs)).select(id_col, "term", "hit")


def _ranked(counts: DataFrame, terms: Sequence[str], *, only_if_input: bool = False) -> DataFrame:
    """Add ``rank`` (1-based) to at most ``len(terms) + 1`` ``(term, n)`` rows.

    A null ``term`` row (articles without a match) only counts as input.  With
    ``only_if_input`` every row is dropped when the input had no article at all.
    """
    pos = term_position("term", terms)
    # windows without partition are fine here: their input is bounded by the term list
    if only_if_input:
        counts = counts.withColumn("_input", F.sum("n").over(Window.partitionBy())).where(F.col("_input") > 0)
    counts = counts.where(F.col("term").isNotNull())
    w = Window.orderBy(F.col("n").desc(), pos)
    return counts.select(F.row_number().over(w).cast("int").alias("rank"), "term",
                         F.col("n").cast("bigint").alias("n")).orderBy("rank")


def _zero_rows(spark, terms: Sequence[str]) -> DataFrame:
    """``(term, hit = 0)`` for every listed term (generated in the plan from one row)."""
    return spark.range(1).select(F.explode(terms_array(terms)).alias("term"), F.lit(0).alias("hit"))


def term_counts(articles: DataFrame, terms: Sequence[str], *, text_col: str = "text") -> DataFrame:
    """``(term, n)`` for the terms that occur; partial+final HashAggregate, one exchange."""
    return (articles.select(F.explode(present_terms(text_col, terms)).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def _complete(matches: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Rank from ``(term, hit)`` match rows plus a zero row per listed term.

    The zero rows join the matches below the one aggregation (a union under the
    partial aggregate): one exchange, no join.
    """
    terms = check_terms(terms)
    counts = (matches.unionByName(_zero_rows(matches.sparkSession, terms))
              .groupBy("term").agg(F.sum("hit").alias("n")))
    return _ranked(counts, terms)


def rank_terms(articles: DataFrame, terms: Sequence[str], *, text_col: str = "text") -> DataFrame:
    """Complete ranking: every listed term, zero counts included."""
    terms = check_terms(terms)
    return _complete(articles.select(F.explode(present_terms(text_col, terms)).alias("term"),
                                     F.lit(1).alias("hit")), terms)


def rank_terms_from_sets(sets: DataFrame, terms: Sequence[str]) -> DataFrame:
    """:func:`rank_terms` from :func:`matched_term_sets`."""
    return _complete(_matched_terms(sets).select("term", F.lit(1).alias("hit")), terms)


def inverted_index(articles: DataFrame, terms: Sequence[str], *, id_col: str = "title",
                   text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Inverted index in long form: ``(term, id[, text])``, one row per posting.

    Terms no article mentions have no rows.  The postings of one term are *not*
    gathered into one record (a frequent term would put most of the corpus into
    one row); :func:`save_inverted_index` lays them out by term on storage and
    :func:`inverted_index_lists` gives bounded per-term lists.
    """
    return explode_present_terms(articles, terms, id_col=id_col, text_col=text_col,
                                 keep_text=keep_text).select("term", id_col,
                                                             *([text_col] if keep_text else []))


def save_inverted_index(index: DataFrame, path: str, *, id_col: str = "title", mode: str = "errorifexists",
                        rows_per_file: int = 5_000_000) -> str:
    """Write the index as Parquet, one folder per term (``term=<t>/``), ids sorted per file.

    Each term's postings are split by a hash of the id into ``ceil(n / rows_per_file)``
    parts and shuffled on (term, part): a term gets about one file per
    ``rows_per_file`` postings -- not one tiny file per input task -- and a hot term
    is still written by many tasks.  The postings are written once to the shared checkpoint
    folder and counted from there, so the text is tokenised once.
    """
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be >= 1")
    index = materialize(index, "postings")
    sizes = index.groupBy("term").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("bigint").alias("_files"))
    keyed = index.join(sizes, "term").withColumn(
        "_part", F.pmod(F.xxhash64(F.col(id_col)), F.col("_files")))
    (keyed.repartition("term", "_part").sortWithinPartitions("term", id_col).drop("_part", "_files")
     .write.mode(mode).partitionBy("term").parquet(path))
    return path


def inverted_index_lists(index: DataFrame, *, id_col: str = "title", max_list: int = 10_000,
                         text_col: str | None = None, max_bytes: int = 64 << 20) -> DataFrame:
    """Posting lists as records: ``(term, part, n_parts, ids array)``, ids sorted; with ``text_col`` (an index made with
    ``keep_text``) ``(term, part, n_parts, articles array<struct<id, text>>)``, sorted by id.

    The nested "term -> its articles" form, in bounded pieces: a term's postings are dealt by id
    (:func:`kestrel.functions.parts.dealt_part` of a numeric id, else of its hash) into ``ceil(n / max_list)``
    parts, with bodies at least ``ceil(bytes / max_bytes)``, so each record holds about ``max_list`` articles and
    ``max_bytes`` of text at most however frequent the term (nothing is dropped; the parts together are the
    whole list).  The postings are written once to the shared checkpoint folder and counted from there, so the
    text is tokenised once.
    """
    if max_list < 1 or max_bytes < 1:
        raise ValueError("max_list and max_bytes must be >= 1")
    index = materialize(index.select("term", id_col, *([text_col] if text_col else [])), "postings")
    parts = F.ceil(F.count(F.lit(1)) / F.lit(max_list))
    if text_col:
        parts = F.greatest(parts, F.ceil(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)) / F.lit(max_bytes)))
    sizes = index.groupBy("term").agg(parts.cast("int").alias("n_parts"))
    numeric = dict(index.dtypes)[id_col] in ("int", "bigint")
    keyed = index.join(sizes, "term").withColumn("_number", F.col(id_col) if numeric else F.xxhash64(id_col))
    keyed = keyed.withColumn("part", dealt_part("_number", "n_parts"))
    own = F.struct(F.col(id_col), F.col(text_col)) if text_col else F.col(id_col)
    return keyed.groupBy("term", "part", "n_parts").agg(
        F.array_sort(F.collect_list(own)).alias("articles" if text_col else "ids"))


def rank_terms_from_index(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Ranking from the index: posting-list sizes; terms that never occur are absent."""
    terms = check_terms(terms)
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return _ranked(counts, terms)


def rank_terms_single_pass(articles: DataFrame, terms: Sequence[str], *, id_col: str = "title",
                           text_col: str = "text") -> DataFrame:
    """Sum of 0/1 indicators per term (map-side combined); zeros present iff input is non-empty."""
    return rank_terms_single_pass_from_sets(
        matched_term_sets(articles, terms, id_col=id_col, text_col=text_col), terms, id_col=id_col)


def rank_terms_single_pass_from_sets(sets: DataFrame, terms: Sequence[str], *, id_col: str = "title") -> DataFrame:
    """:func:`rank_terms_single_pass` from :func:`matched_term_sets`.

    The sum of an article's 0/1 indicators over all articles is the number of
    articles that mention the term, so only matches are counted and the zero
    indicators (``len(terms)`` rows per article) are never generated.  An article
    without a match still counts as input (``explode_outer`` gives it a null term);
    the listed terms' zero rows enter the same aggregation, and the ranking is empty
    exactly when no article was read.
    """
    terms = check_terms(terms)
    matches = sets.select(F.explode_outer("matched").alias("term"), F.lit(1).alias("hit"))
    counts = (matches.unionByName(_zero_rows(sets.sparkSession, terms))
              .groupBy("term").agg(F.sum("hit").alias("n")))
    return _ranked(counts, terms, only_if_input=True)


def top_term(ranking: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` best ranked rows (``TakeOrderedAndProject``)."""
    return ranking.orderBy("rank").limit(k)
