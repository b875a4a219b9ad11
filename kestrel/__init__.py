"""kestrel: text-term ranking and Q&A clustering as Spark DataFrame jobs.

Every operator takes and returns a DataFrame; see README.md for the inventory.
"""

from kestrel.operators.checks import diff_rows, expect_row_count, order_violations
from kestrel.operators.kmeans import (assign_nearest, average_vectors, center_displacement, converged, kmeans,
                                      lloyd_step, weighted_points)
from kestrel.operators.lists import strict_max, sum_or_zero
from kestrel.operators.qa import (answer_keys, filter_answers, filter_questions, grouped_pair_lists,
                                  grouped_postings,
                                  join_questions_answers, scored_postings, vector_postings, with_category_index)
from kestrel.operators.ranking import (explode_present_terms, inverted_index, inverted_index_lists,
                                       matched_term_sets, mentions_term,
                                       occurrences_of_term, rank_terms, rank_terms_from_index,
                                       rank_terms_single_pass, save_inverted_index, term_indicator, top_term)
from kestrel.operators.report import (cluster_dominant, cluster_median, cluster_membership, cluster_report_lines,
                                      cluster_results, cluster_size)
from kestrel.operators.sampling import global_sample, initial_centres, sample_stratum_check, stratified_sample
from kestrel.plans.qa_clustering import cluster_vectors, qa_cluster_pipeline, qa_vectors
from kestrel.plans.term_ranking import term_ranking_pipeline
from kestrel.sources.articles import parse_article_lines
from kestrel.sources.lines import read_lines, write_lines
from kestrel.sources.postings import parse_postings

__all__ = [
    "answer_keys", "assign_nearest", "average_vectors", "center_displacement", "cluster_dominant",
    "cluster_median", "cluster_membership", "cluster_report_lines", "cluster_results", "cluster_size",
    "cluster_vectors", "converged", "diff_rows", "expect_row_count", "explode_present_terms", "filter_answers",
    "filter_questions", "global_sample", "grouped_pair_lists", "grouped_postings", "initial_centres", "inverted_index", "inverted_index_lists",
    "join_questions_answers", "kmeans", "lloyd_step", "matched_term_sets", "mentions_term",
    "occurrences_of_term", "order_violations", "parse_article_lines", "parse_postings", "qa_cluster_pipeline",
    "qa_vectors", "rank_terms", "rank_terms_from_index", "rank_terms_single_pass", "read_lines",
    "sample_stratum_check", "save_inverted_index", "scored_postings", "strict_max", "stratified_sample",
    "sum_or_zero", "term_indicator", "term_ranking_pipeline", "top_term", "vector_postings", "weighted_points",
    "with_category_index", "write_lines",
]
