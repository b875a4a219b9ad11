"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or views Spark derives from them, see
:mod:`kestrel.plans.fixtures`) in full.  Column names match the SQL twins in
:mod:`kestrel.plans.oracle_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.arith import int_div
from kestrel.functions.categories import category_label
from kestrel.operators import checks, kmeans as KM, lists, qa, ranking as R, report, sampling
from kestrel.plans import fixtures as FX
from kestrel.plans.oracle_sql import MAX_PAIRS, MAX_POSTINGS
from kestrel.plans.qa_clustering import cluster_vectors, qa_cluster_pipeline
from kestrel.plans.term_ranking import term_ranking_pipeline
from kestrel.session import Scratch, materialize, scratch_path
from kestrel.sources.articles import parse_article_lines
from kestrel.sources.lines import read_lines, write_lines
from kestrel.sources.postings import parse_postings

Query = Callable[[SparkSession, str], DataFrame]

TERMS = FX.FIXTURE_TERMS
CATS = FX.ORDER_PRIORITIES
K = FX.FIXTURE_K
ETA = FX.FIXTURE_ETA
SPREAD = FX.FIXTURE_SPREAD
MIXED = FX.FIXTURE_MIXED_SPREAD
PER_STRATUM = K // len(CATS)
# record separator for article lines: article bodies contain newlines
ARTICLE_LINE_SEP = "\x1e"


def _docs(spark, sf):
    return FX.documents(spark, sf)


# ------------------------------------------------------------------ text ranking

def q_mentions_term(spark, sf):
    return R.mentions_term(_docs(spark, sf), TERMS[0], keep=("doc_id",))


def q_explode_present_terms(spark, sf):
    return R.explode_present_terms(_docs(spark, sf), TERMS, id_col="doc_id")


def q_term_indicator(spark, sf):
    return R.term_indicator(_docs(spark, sf), TERMS, id_col="doc_id")


def q_occurrences_of_term(spark, sf):
    return R.occurrences_of_term(_docs(spark, sf), TERMS[0])


def q_rank_terms(spark, sf):
    return R.rank_terms(_docs(spark, sf), TERMS)


def q_inverted_index(spark, sf):
    return R.inverted_index(_docs(spark, sf), TERMS, id_col="doc_id")


def q_rank_terms_from_index(spark, sf):
    return R.rank_terms_from_index(q_inverted_index(spark, sf), TERMS)


def q_rank_terms_single_pass(spark, sf):
    return R.rank_terms_single_pass(_docs(spark, sf), TERMS, id_col="doc_id")


def q_top_term(spark, sf):
    return R.top_term(q_rank_terms(spark, sf))


def q_read_article_lines(spark, sf):
    path = write_lines(FX.fx_article_lines(spark, sf), "line", scratch_path(spark, "article-lines"),
                       line_sep=ARTICLE_LINE_SEP)
    return read_lines(spark, path, line_sep=ARTICLE_LINE_SEP)


def q_parse_article_lines(spark, sf):
    return parse_article_lines(FX.fx_article_lines(spark, sf), "line", keep=["doc_id"])


def q_term_ranking_pipeline(spark, sf):
    return term_ranking_pipeline(FX.fx_article_lines(spark, sf), TERMS, line_col="line")


# ------------------------------------------------------------------ postings

def q_read_posting_lines(spark, sf):
    path = write_lines(FX.fx_posting_lines(spark, sf), "line", scratch_path(spark, "posting-lines"))
    return read_lines(spark, path)


def q_parse_postings(spark, sf):
    return parse_postings(FX.fx_posting_lines(spark, sf), "line")


def q_qa_cluster_pipeline(spark, sf):
    return qa_cluster_pipeline(FX.fx_posting_lines(spark, sf), CATS, spread=SPREAD, k=K, eta=ETA,
                               line_col="line").results


def q_filter_questions(spark, sf):
    return qa.filter_questions(FX.fx_postings(spark, sf))


def q_filter_answers(spark, sf):
    return qa.filter_answers(FX.fx_postings(spark, sf))


def q_answer_keys(spark, sf):
    return qa.answer_keys(FX.fx_postings(spark, sf))


def q_join_questions_answers(spark, sf):
    return qa.join_questions_answers(FX.fx_postings(spark, sf))


def q_grouped_postings(spark, sf):
    return qa.grouped_postings(FX.fx_postings(spark, sf))


def q_grouped_pair_parts(spark, sf):
    parts = qa.grouped_pair_lists(FX.fx_postings(spark, sf), max_list=MAX_PAIRS)
    spelled = F.transform("answers", lambda a: F.concat_ws(":", a["answer_id"], a["answer_score"]))
    return parts.select("question_id", "part", "n_parts", "q_accepted_answer", "q_score", "q_tags",
                        F.array_join(spelled, ",").alias("answers"))


def q_inverted_index_parts(spark, sf):
    parts = R.inverted_index_lists(q_inverted_index(spark, sf), id_col="doc_id", max_list=MAX_POSTINGS)
    return parts.select("term", "part", "n_parts", F.array_join(F.col("ids").cast("array<string>"), ",").alias("doc_ids"))


def q_scored_postings(spark, sf):
    return qa.scored_postings(FX.fx_postings(spark, sf))


def q_category_index(spark, sf):
    return qa.with_category_index(qa.filter_questions(FX.fx_postings(spark, sf)), CATS).select(
        "id", "tags", "category")


def q_vector_postings(spark, sf):
    return FX.fx_vectors(spark, sf)


# ------------------------------------------------------------------ vectors, samples, k-means

def q_expect_row_count(spark, sf):
    # expectation derived independently of the vectors: questions that have an answer
    p = FX.fx_postings(spark, sf)
    answered = (qa.filter_questions(p).select("id")
                .join(qa.filter_answers(p).select(F.col("parent_id").alias("id")), "id", "left_semi").distinct())
    return checks.expect_row_count(FX.fx_vectors(spark, sf), answered)


def q_category_label(spark, sf):
    return FX.fx_vectors(spark, sf).select("question_id", "x", category_label("x", CATS, SPREAD).alias("label"))


def q_stratified_sample(spark, sf):
    return sampling.stratified_sample(FX.fx_vectors(spark, sf), PER_STRATUM)


def q_sample_stratum_check(spark, sf):
    return sampling.sample_stratum_check(FX.fx_vectors(spark, sf), CATS, SPREAD, PER_STRATUM)


def _seeds(vectors: DataFrame, spread: int):
    return sampling.initial_centres(vectors, K, CATS, spread)


def _clustered(spark, sf, spread: int):
    """Vectors computed once (materialised), seeds, k-means on the weighted points, report."""
    return cluster_vectors(FX.fx_vectors(spark, sf, spread), CATS, spread=spread, k=K, eta=ETA)


def _run(spark, sf, spread: int) -> KM.KMeansResult:
    with _clustered(spark, sf, spread) as result:
        return result.kmeans


def _one_step(spark, sf) -> tuple[list, list]:
    """The seeds and the centres after one step."""
    with Scratch(spark) as scratch:
        vectors = scratch.materialize(FX.fx_vectors(spark, sf), "step-vectors")
        seeds = _seeds(vectors, SPREAD)
        with KM.LloydPoints(scratch.materialize(KM.weighted_points(vectors), "step-points"), scratch) as points:
            return seeds, points.step(seeds)


def q_kmeans_step(spark, sf):
    return KM.centres_frame(spark, _one_step(spark, sf)[1])


def q_center_displacement(spark, sf):
    disp = KM.center_displacement(*_one_step(spark, sf))
    return spark.createDataFrame([(disp,)], "displacement double")


def q_kmeans_converged(spark, sf):
    result = _run(spark, sf, SPREAD)
    return KM.trace_frame(spark, result).select(
        "iter", "displacement", F.lit(ETA).alias("eta"), "converged").distinct()


def q_kmeans_trace(spark, sf):
    return KM.trace_frame(spark, _run(spark, sf, SPREAD))


def q_kmeans_centers(spark, sf):
    return KM.centres_frame(spark, _run(spark, sf, SPREAD).centres)


def q_global_sample(spark, sf):
    return sampling.global_sample(FX.fx_vectors_mixed(spark, sf), K)


def q_squared_distance(spark, sf):
    vectors = materialize(FX.fx_vectors_mixed(spark, sf), "mixed-vectors")
    return KM.distance_to(vectors, _seeds(vectors, MIXED)[0]).select("question_id", "dist")


def q_assign_nearest(spark, sf):
    vectors = materialize(FX.fx_vectors_mixed(spark, sf), "mixed-vectors")
    return KM.assign_nearest(vectors, _seeds(vectors, MIXED)).select("question_id", "cluster", "dist")


def q_average_vectors(spark, sf):
    vectors = FX.fx_vectors_mixed(spark, sf).withColumn("category", int_div("x", MIXED).cast("int"))
    return KM.average_vectors(vectors, ["category"])


def q_cluster_membership(spark, sf):
    c = _clustered(spark, sf, MIXED)
    return report.cluster_membership(c.vectors, c.kmeans.centres)


def q_cluster_dominant(spark, sf):
    return report.cluster_dominant(q_cluster_membership(spark, sf), CATS, MIXED)


def q_cluster_size(spark, sf):
    return report.cluster_size(q_cluster_membership(spark, sf))


def q_cluster_median(spark, sf):
    return report.cluster_median(q_cluster_membership(spark, sf))


def q_cluster_results(spark, sf):
    return _clustered(spark, sf, MIXED).results


def q_cluster_report_lines(spark, sf):
    return _clustered(spark, sf, MIXED).report


# ------------------------------------------------------------------ lists and checks

def q_sum_or_zero(spark, sf):
    return lists.sum_or_zero(FX.fx_numbers(spark, sf))


def q_strict_max(spark, sf):
    return lists.strict_max(FX.fx_numbers(spark, sf))


def q_diff_rows(spark, sf):
    return checks.diff_rows(q_rank_terms_from_index(spark, sf).drop("rank"), q_rank_terms(spark, sf).drop("rank"))


def q_order_violations(spark, sf):
    return checks.order_violations(q_rank_terms(spark, sf), expected=q_rank_terms_single_pass(spark, sf))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
