"""Views derived from the driver tables, shared by ``queries()`` and the DuckDB oracle.

Each fixture exists twice: as a Spark DataFrame built from ``{sf_dir}/{table}.parquet``
and as a SQL text over the same tables, so the oracle recomputes it independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.qa import scored_vectors

# --- fixed values: fixture parameters ---
FIXTURE_TERMS = ["the", "of", "and", "la", "der", "und", "que", "el", "is", "zzz"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FIXTURE_SPREAD = 50000
FIXTURE_MIXED_SPREAD = 10
FIXTURE_K = 15
FIXTURE_ETA = 20.0
FIXTURE_SEED = 42
ANSWER_ID_BASE = 10000000
LINE_PREFIX = "<page> <title>doc_"
LINE_SUFFIX = "</text>  </page>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fx_article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line)``: each document as one raw article line."""
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit(LINE_PREFIX), F.col("doc_id").cast("string"), F.lit("</title><text>"),
                 F.col("text"), F.lit(LINE_SUFFIX)).alias("line"))


def fx_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as questions (tag = priority), line items as their answers."""
    questions = table(spark, sf_dir, "orders").select(
        F.lit(1).cast("int").alias("posting_type"),
        F.col("o_orderkey").cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"),
        (F.floor("o_totalprice").cast("int") % 100).alias("score"),
        F.col("o_orderpriority").alias("tags"))
    answers = table(spark, sf_dir, "lineitem").select(
        F.lit(2).cast("int").alias("posting_type"),
        (F.lit(ANSWER_ID_BASE) + F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.col("l_orderkey").cast("bigint").alias("parent_id"),
        (F.col("l_quantity").cast("int") - 25).alias("score"),
        F.lit(None).cast("string").alias("tags"))
    return questions.unionByName(answers)


def fx_posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, line)``: postings as CSV lines; a null tag leaves out the tag and its comma."""
    p = fx_postings(spark, sf_dir)

    def s(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    line = F.concat(s("posting_type"), F.lit(","), s("id"), F.lit(","), s("accepted_answer"), F.lit(","),
                    s("parent_id"), F.lit(","), s("score"),
                    F.coalesce(F.concat(F.lit(","), F.col("tags")), F.lit("")))
    return p.select("id", line.alias("line"))


def fx_vectors(spark: SparkSession, sf_dir: str, spread: int = FIXTURE_SPREAD) -> DataFrame:
    return scored_vectors(fx_postings(spark, sf_dir), ORDER_PRIORITIES, spread)


def fx_vectors_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_vectors(spark, sf_dir, FIXTURE_MIXED_SPREAD)


def fx_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.floor("value").cast("int").alias("v"))


# ---------------------------------------------------------------- SQL twins (DuckDB)

def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


PRIORITIES_SQL = _sql_list(ORDER_PRIORITIES)

FX_SQL = {
    "fx_article_lines": f"""
        SELECT doc_id, '{LINE_PREFIX}' || CAST(doc_id AS VARCHAR) || '</title><text>' || text
               || '{LINE_SUFFIX}' AS line
        FROM documents""",
    "fx_postings": f"""
        SELECT CAST(1 AS INTEGER) AS posting_type, CAST(o_orderkey AS BIGINT) AS id,
               CAST(NULL AS BIGINT) AS accepted_answer, CAST(NULL AS BIGINT) AS parent_id,
               CAST(floor(o_totalprice) AS INTEGER) % 100 AS score, o_orderpriority AS tags
        FROM orders
        UNION ALL
        SELECT CAST(2 AS INTEGER), CAST({ANSWER_ID_BASE} + l_orderkey * 10 + l_linenumber AS BIGINT),
               CAST(NULL AS BIGINT), CAST(l_orderkey AS BIGINT),
               CAST(l_quantity AS INTEGER) - 25, CAST(NULL AS VARCHAR)
        FROM lineitem""",
    "fx_posting_lines": """
        SELECT id, CAST(posting_type AS VARCHAR) || ',' || CAST(id AS VARCHAR) || ','
               || coalesce(CAST(accepted_answer AS VARCHAR), '') || ','
               || coalesce(CAST(parent_id AS VARCHAR), '') || ',' || CAST(score AS VARCHAR)
               || coalesce(',' || tags, '') AS line
        FROM fx_postings""",
    "fx_scored": """
        SELECT q.id AS question_id, q.accepted_answer, q.score, q.tags,
               CAST(greatest(max(a.score), 0) AS INTEGER) AS high_score
        FROM fx_postings q JOIN fx_postings a ON a.parent_id = q.id
        WHERE q.posting_type = 1 AND a.posting_type = 2
        GROUP BY q.id, q.accepted_answer, q.score, q.tags""",
    "fx_vectors": f"""
        SELECT question_id, CAST((list_position({PRIORITIES_SQL}, tags) - 1) * {FIXTURE_SPREAD} AS INTEGER) AS x,
               high_score AS y
        FROM fx_scored""",
    "fx_vectors_mixed": f"""
        SELECT question_id, CAST((list_position({PRIORITIES_SQL}, tags) - 1) * {FIXTURE_MIXED_SPREAD} AS INTEGER) AS x,
               high_score AS y
        FROM fx_scored""",
    "fx_numbers": """
        SELECT event_id, user_id, CAST(floor(value) AS INTEGER) AS v FROM events""",
}

# which fixture needs which other fixture (CTE order)
_FX_DEPS = {
    "fx_article_lines": [],
    "fx_postings": [],
    "fx_posting_lines": ["fx_postings"],
    "fx_scored": ["fx_postings"],
    "fx_vectors": ["fx_postings", "fx_scored"],
    "fx_vectors_mixed": ["fx_postings", "fx_scored"],
    "fx_numbers": [],
}


def with_fixtures(names: list[str], extra_ctes: list[tuple[str, str]], final_select: str) -> str:
    """``WITH <fixtures needed>, <extra ctes> <final select>`` for DuckDB."""
    order: list[str] = []
    for n in names:
        for dep in _FX_DEPS[n] + [n]:
            if dep not in order:
                order.append(dep)
    # MATERIALIZED: later CTEs reference earlier ones several times (k-means chain)
    ctes = ([f"{n} AS MATERIALIZED ({FX_SQL[n]})" for n in order]
            + [f"{n} AS MATERIALIZED ({body})" for n, body in extra_ctes])
    head = ("WITH " + ",\n".join(ctes) + "\n") if ctes else ""
    return head + final_select
