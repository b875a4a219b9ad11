"""The driver contract: every query has a SQL twin, and the smoke entry runs."""

import os
import sys

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

REGISTRY_KEYS = """mentions_term explode_present_terms term_indicator occurrences_of_term rank_terms inverted_index
rank_terms_from_index rank_terms_single_pass top_term read_article_lines parse_article_lines term_ranking_pipeline
read_posting_lines parse_postings qa_cluster_pipeline filter_questions filter_answers answer_keys
join_questions_answers grouped_postings scored_postings category_index vector_postings expect_row_count
category_label stratified_sample sample_stratum_check kmeans_step center_displacement kmeans_converged kmeans_trace
kmeans_centers global_sample squared_distance assign_nearest average_vectors cluster_membership cluster_dominant
cluster_size cluster_median cluster_results cluster_report_lines sum_or_zero strict_max diff_rows
order_violations grouped_pair_parts inverted_index_parts""".split()


def test_every_query_has_an_oracle():
    extra = {k for k in E.queries() if k.startswith("op") or k == "pipeline"}  # some have no SQL form
    assert set(E.queries()) - extra == set(E.oracle_sql()) - extra and set(E.oracle_sql()) <= set(E.queries())
    assert set(REGISTRY_KEYS) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    got = df.collect()
    assert df.columns == ["rank", "term", "n"] and len(got) == 10


def test_oracle_sql_runs_in_duckdb_for_a_sample():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "orders", "lineitem", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = E.oracle_sql()
    assert con.sql(sql["rank_terms"]).fetchall()[0][0] == 1
    assert len(con.sql(sql["kmeans_centers"]).fetchall()) == 15


def test_the_other_queries_stay_when_the_training_data_queries_cannot_be_imported():
    """Neither their modules nor a library that only they need has to be there."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for absent in ("corpus_pipeline", "kestrel.llm", "xxhash"):
        code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
        done = subprocess.run([sys.executable, "-W", "error::SyntaxWarning", "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
        assert done.stdout.split() == ["48", "48"], (absent, done)
        assert "left out" in done.stderr
