"""Plan shapes that matter at scale: hot keys split or combined, pruning before shuffles."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, conf_override, executed_plan
from kestrel.operators import qa, sampling
from kestrel.plans import fixtures as FX


def skewed_postings(spark, n_cold=2000, n_answers=60000):
    """Question 0 owns a third of all answers."""
    q = spark.range(n_cold + 1).select(
        F.lit(1).alias("posting_type"), F.col("id"), F.lit(None).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"), F.lit(0).alias("score"), F.lit("Java").alias("tags"))
    a = spark.range(n_answers).select(
        F.lit(2).alias("posting_type"), (F.col("id") + 10**6).alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.when(F.col("id") < n_answers // 3, F.lit(0)).otherwise(F.col("id") % n_cold + 1).cast("bigint")
        .alias("parent_id"),
        (F.col("id") % 7).cast("int").alias("score"), F.lit(None).cast("string").alias("tags"))
    return q.unionByName(a)


def test_hot_question_join_partition_is_split(spark):
    settings = {"spark__sql__autoBroadcastJoinThreshold": "-1",
                "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
                "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4KB",
                "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4KB",
                "spark__sql__adaptive__coalescePartitions__enabled": "false",
                "spark__sql__shuffle__partitions": "16"}
    with conf_override(spark, **settings):
        joined = qa.join_questions_answers(skewed_postings(spark))
        plan = executed_plan(joined)
        assert "SortMergeJoin(skew=true)" in plan, plan
        assert joined.count() == 60000


def test_hot_question_is_combined_map_side(spark):
    scored = qa.scored_postings(skewed_postings(spark))
    plan = executed_plan(scored)
    # one co-grouping aggregation: partial before the single exchange, no join
    assert "Join" not in plan, plan
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "partial_max" in plan and "partial_count" in plan
    got = {r["question_id"]: r["high_score"] for r in scored.where("question_id = 0").collect()}
    assert got == {0: 6}


def test_grouping_does_not_read_the_question_record(spark):
    plan = executed_plan(qa.grouped_postings(FX.fx_postings(spark, SF_SMALL)))
    assert "SortAggregate" not in plan and "HashAggregate" in plan, plan


def test_stratified_sample_limits_before_the_shuffle(spark):
    plan = executed_plan(sampling.stratified_sample(FX.fx_vectors(spark, SF_SMALL), 3))
    lines = plan.splitlines()
    limits = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
    exchanges = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(x" in l]
    assert limits and exchanges, plan
    # a WindowGroupLimit sits below (printed after) the exchange on x: rows are cut per task first
    assert max(limits) > min(exchanges), plan


def test_global_sample_is_top_k(spark):
    plan = executed_plan(sampling.global_sample(FX.fx_vectors(spark, SF_SMALL), 15))
    assert "TakeOrderedAndProject" in plan, plan


def test_no_python_or_cartesian_nodes_in_registered_queries(spark):
    import __spark_entry__ as E
    for name in E.queries():
        if name.startswith("op") or name == "pipeline":
            continue
        plan = executed_plan(E.queries()[name](spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_text_is_split_once_per_scan(spark):
    """Catalyst must not copy the split into pushed-down (inferred) filters."""
    import re
    from kestrel.operators import ranking as R
    from kestrel.sources.postings import parse_postings
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    terms = ["the", "of"]
    lines = FX.fx_posting_lines(spark, SF_SMALL)
    cases = {
        "rank_terms_from_index": (R.rank_terms_from_index(R.inverted_index(docs, terms, id_col="doc_id"), terms), 1),
        "inverted_index": (R.inverted_index(docs, terms, id_col="doc_id"), 1),
        "rank_terms": (R.rank_terms(docs, terms), 1),
        "rank_terms_single_pass": (R.rank_terms_single_pass(docs, terms, id_col="doc_id"), 1),
        # two line sources (orders, lineitem) per side of the join
        "join_questions_answers": (qa.join_questions_answers(parse_postings(lines, "line")), 4),
        "scored_postings": (qa.scored_postings(parse_postings(lines, "line")), 2),
        "join_questions_answers (non-strict)": (
            qa.join_questions_answers(parse_postings(lines, "line"), strict=False), 4),
        # no question has more than one part here: the lookup of parts drops out at run time
        "grouped_pair_lists": (qa.grouped_pair_lists(parse_postings(lines, "line")), 4),
    }
    for name, (df, scans) in cases.items():
        plan = executed_plan(df)
        assert len(re.findall(r"\bsplit\(", plan)) == scans, (name, plan)


def test_article_separator_located_once(spark):
    import re
    from kestrel.sources.articles import parse_article_lines
    for mode in ("raise", "drop"):
        df = parse_article_lines(FX.fx_article_lines(spark, SF_SMALL), "line", on_error=mode)
        assert len(re.findall(r"\binstr\(", executed_plan(df))) == 1, mode
