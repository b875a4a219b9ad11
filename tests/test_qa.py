"""Questions/answers: two answered questions, one without answers, and strictness edges."""

import pytest
from pyspark.sql import functions as F

from conftest import raises_spark, rows
from kestrel.constants import DEFAULT_SPREAD, DEFAULT_TERMS
from kestrel.operators import qa
from kestrel.sources.postings import POSTING_SCHEMA

POSTINGS = [
    (1, 31, 33, None, 2, "Scala"),
    (2, 32, None, 31, 4, None),
    (2, 33, None, 31, 17, None),
    (1, 70, None, None, 1, "Python"),
    (2, 71, None, 70, 0, None),
    (2, 74, None, 70, 8, None),
    (2, 72, None, 70, 3, None),
    (1, 90, None, None, 6, "Ruby"),
]


@pytest.fixture
def postings(spark):
    return spark.createDataFrame(POSTINGS, POSTING_SCHEMA)


def test_grouped_postings(postings):
    assert sorted(rows(qa.grouped_postings(postings))) == [(31, 2), (70, 3)]


def test_join_pairs(postings):
    pairs = rows(qa.join_questions_answers(postings), "question_id", "answer_id")
    assert sorted(pairs) == [(31, 32), (31, 33), (70, 71), (70, 72), (70, 74)]


def test_scored_and_vectors(postings):
    scored = qa.scored_postings(postings)
    assert sorted(rows(scored, "question_id", "high_score")) == [(31, 17), (70, 8)]
    vec = qa.vector_postings(scored, DEFAULT_TERMS, DEFAULT_SPREAD)
    assert sorted(rows(vec, "x", "y")) == sorted([(DEFAULT_TERMS.index("Scala") * DEFAULT_SPREAD, 17), (DEFAULT_TERMS.index("Python") * DEFAULT_SPREAD, 8)])


def test_negative_answers_give_zero(spark):
    df = spark.createDataFrame([(1, 1, None, None, 0, "Java"), (2, 2, None, 1, -3, None),
                                (2, 3, None, 1, -1, None)], POSTING_SCHEMA)
    assert rows(qa.scored_postings(df), "high_score") == [(0,)]


def test_duplicate_question_ids_multiply_pairs(spark):
    df = spark.createDataFrame([(1, 1, None, None, 0, "Java"), (1, 1, None, None, 3, "Scala"),
                                (2, 2, None, 1, 4, None)], POSTING_SCHEMA)
    assert rows(qa.grouped_postings(df)) == [(1, 2)]
    assert rows(qa.join_questions_answers(df).groupBy().count()) == [(2,)]
    # one scored row per id, smallest question record
    assert rows(qa.scored_postings(df), "tags", "high_score") == [("Java", 4)]


def test_null_parent_raises(spark):
    df = spark.createDataFrame([(1, 1, None, None, 0, "Java"), (2, 2, None, None, 4, None)], POSTING_SCHEMA)
    for fn in (qa.grouped_postings, qa.scored_postings, qa.join_questions_answers, qa.answer_keys):
        raises_spark(lambda fn=fn: fn(df).collect(), "answer posting without a parent id")
    assert rows(qa.scored_postings(df, strict=False)) == []


def test_unknown_tag_raises(spark):
    df = spark.createDataFrame([(1, 1, None, None, 0, "Cobol"), (2, 2, None, 1, 4, None)], POSTING_SCHEMA)
    scored = qa.scored_postings(df)
    raises_spark(lambda: qa.vector_postings(scored, DEFAULT_TERMS, DEFAULT_SPREAD).collect(),
                 "not in the category list")
    assert rows(qa.vector_postings(scored, DEFAULT_TERMS, DEFAULT_SPREAD, strict=False)) == []


def test_unknown_tag_of_unanswered_question_is_harmless(spark):
    df = spark.createDataFrame([(1, 1, None, None, 0, "Cobol"), (1, 3, None, None, 0, "Java"),
                                (2, 2, None, 3, 4, None)], POSTING_SCHEMA)
    assert rows(qa.vector_postings(qa.scored_postings(df), DEFAULT_TERMS, DEFAULT_SPREAD), "x", "y") == [(50000, 4)]


def test_category_index(spark, postings):
    got = rows(qa.with_category_index(qa.filter_questions(postings), DEFAULT_TERMS), "id", "category")
    assert sorted(got) == [(31, DEFAULT_TERMS.index("Scala")), (70, DEFAULT_TERMS.index("Python")),
                           (90, DEFAULT_TERMS.index("Ruby"))]
    df = spark.createDataFrame([(1, 5, None, None, 0, None), (1, 6, None, None, 0, "Nope")], POSTING_SCHEMA)
    assert rows(qa.with_category_index(df, DEFAULT_TERMS), "category") == [(None,), (None,)]


def test_other_posting_types_vanish(spark):
    df = spark.createDataFrame([(3, 1, None, None, 0, "Java"), (1, 2, None, None, 0, "Java"),
                                (2, 3, None, 2, 1, None)], POSTING_SCHEMA)
    assert rows(qa.filter_questions(df), "id") == [(2,)]
    assert rows(qa.filter_answers(df), "id") == [(3,)]


def test_spread_that_overflows_x_is_rejected(postings):
    with pytest.raises(ValueError):
        qa.vector_postings(qa.scored_postings(postings), DEFAULT_TERMS, 2**30)


def test_pipeline_expected_vector_count(spark):
    from kestrel.plans import fixtures as FX
    from kestrel.plans.qa_clustering import qa_cluster_pipeline
    from conftest import SF_SMALL
    lines = FX.fx_posting_lines(spark, SF_SMALL)
    n = FX.fx_vectors(spark, SF_SMALL).count()
    res = qa_cluster_pipeline(lines, FX.ORDER_PRIORITIES, spread=50000, k=5, line_col="line", expected_vectors=n)
    assert res.vectors.count() == n
    raises_spark(lambda: qa_cluster_pipeline(lines, FX.ORDER_PRIORITIES, spread=50000, k=5, line_col="line",
                                             expected_vectors=n + 1), "row count differs")


def test_grouped_pair_lists(postings, spark):
    got = qa.grouped_pair_lists(postings).collect()
    by_q = {r["question_id"]: r for r in got}
    assert set(by_q) == {31, 70} and all(r["n_parts"] == 1 for r in got)
    assert [a["answer_id"] for a in by_q[70]["answers"]] == [71, 72, 74]
    assert by_q[31]["q_tags"] == "Scala"
    # a hot question is split into bounded parts, every pair kept
    from test_plans import skewed_postings
    parts = qa.grouped_pair_lists(skewed_postings(spark), max_list=1000)
    lists = parts.where("question_id = 0").collect()
    assert len(lists) == 20 and all(r["n_parts"] == 20 for r in lists)
    assert sum(len(r["answers"]) for r in lists) == 20000
    assert max(len(r["answers"]) for r in lists) <= 1000


def test_pairs_are_never_keyed_on_the_bare_question(spark):
    from conftest import executed_plan
    from test_plans import skewed_postings
    plan = executed_plan(qa.grouped_pair_lists(skewed_postings(spark), max_list=1000))
    inner = [line for line in plan.splitlines() if "Join" in line and "Inner" in line]
    assert len(inner) == 1 and "part" in inner[0]
    groups = [line for line in plan.splitlines() if "collect_list" in line]
    assert groups and all("part#" in line for line in groups)


def test_strict_counts_run_the_checks(spark, postings):
    from kestrel.operators.checks import expect_row_count
    scored = qa.scored_postings(postings)
    assert rows(expect_row_count(qa.vector_postings(scored, DEFAULT_TERMS, 500), 2), "n", "ok") == [(2, True)]
    assert rows(expect_row_count(scored, scored), "n", "expected", "ok") == [(2, 2, True)]
    assert rows(expect_row_count(scored.limit(0), 0), "n", "ok") == [(0, True)]
    unknown = qa.vector_postings(scored, ["Fortran"], 500)
    raises_spark(lambda: expect_row_count(unknown, 2).collect(), "")


def test_stepped_answer_ids_fill_all_parts(spark):
    """A hot question whose answers' ids share their remainder still has bounded parts."""
    for step, per_part in ((1, 0), (7, 60), (20, 60), (1000, 60), (2**40, 60)):
        q = spark.createDataFrame([(1, 0, None, None, 3, "Java")], POSTING_SCHEMA)
        a = spark.range(2000).select(F.lit(2).alias("posting_type"), (F.col("id") * step).alias("id"), F.lit(None).cast("bigint"),
                                     F.lit(0).cast("bigint").alias("parent_id"), F.lit(1).alias("score"), F.lit(None).cast("string"))
        parts = qa.grouped_pair_lists(q.union(a), max_list=100).collect()
        assert sorted(r["part"] for r in parts) == list(range(20)), step
        assert sum(len(r["answers"]) for r in parts) == 2000 and max(len(r["answers"]) for r in parts) <= 100 + per_part


def test_answers_without_an_id_are_kept(spark):
    p = spark.createDataFrame([(1, 5, None, None, 3, "Java")] + [(2, i, None, 5, 1, None) for i in [None, None, -3, 8, 9]], POSTING_SCHEMA)
    parts = qa.grouped_pair_lists(p, max_list=2).collect()
    assert sum(len(r["answers"]) for r in parts) == 5


def test_vectors_are_made_without_sorting_and_equal_the_two_steps(spark):
    import random
    from conftest import executed_plan
    rnd = random.Random(9)
    tags = ["Java", "C#", "Zig", "", None, "Ada", "Scala", "Jav", "JavaScript"]
    cats = ["Scala", "Java", "C#", "JavaScript"]
    big = [None, 0, -1, 2**63 - 1, -2**63, 5]
    rows_ = [(1, rnd.randint(0, 60), rnd.choice(big), None, rnd.choice([-2**31, 2**31 - 1, 0, 3]), rnd.choice(tags)) for _ in range(250)]
    rows_ += [(2, 1000 + i, None, rnd.randint(0, 60), rnd.randint(-9, 9), None) for i in range(300)] + [(3, 1, None, None, 1, "Java")]
    p = spark.createDataFrame(rows_, POSTING_SCHEMA)
    got = qa.scored_vectors(p, cats, 500, strict=False)
    want = qa.vector_postings(qa.scored_postings(p), cats, 500, strict=False)
    assert sorted(rows(got)) == sorted(rows(want)) and want.count() > 5
    plan = executed_plan(got)
    assert "Sort" not in plan and plan.count("Exchange hashpartitioning") == 1
    raises_spark(lambda: qa.scored_vectors(p, cats, 500).collect(), "not in the category list")
    fine = p.where("posting_type <> 1 or tags in ('Scala', 'Java', 'C#')")
    assert sorted(rows(qa.scored_vectors(fine, cats, 500))) == sorted(
        rows(qa.vector_postings(qa.scored_postings(fine), cats, 500)))
