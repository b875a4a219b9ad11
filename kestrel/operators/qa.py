"""Questions and answers: split, key, join, group, score, project to vectors.

Input is a postings DataFrame ``(posting_type, id, accepted_answer, parent_id, score, tags)``.

Scale notes.  One question may own a third of all answers.  :func:`join_questions_answers`
emits every pair (its output *is* that large) and relies on AQE's skew-join split for
such keys.  Everything downstream of the pairs -- grouping, scoring, vectors -- never
materialises them: questions and answers are co-grouped by one aggregation keyed by
question id, combined map-side, so a hot question is a handful of partial rows per
task and the input is scanned and parsed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.constants import ANSWER_TYPE, QUESTION_TYPE
from kestrel.functions.categories import category_index, category_x, category_x_of_code, check_reach, tag_code
from kestrel.functions.parts import dealt_part
from kestrel.functions.strict import required

ANSWER_WITHOUT_PARENT = "answer posting without a parent id"


def filter_questions(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("posting_type") == QUESTION_TYPE)


def filter_answers(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("posting_type") == ANSWER_TYPE)


def _answer_key(strict: bool):
    key = F.col("parent_id")
    return required(key, ANSWER_WITHOUT_PARENT) if strict else key


def answer_keys(postings: DataFrame, *, strict: bool = True) -> DataFrame:
    """Answers keyed by their question: ``(question_id, answer_id, answer_score)``.

    Strict (default): an answer with a null parent fails the job.  The key is an
    expression, so Catalyst cannot replace the failure by an inferred ``isnotnull``
    filter.  Non-strict: such answers are dropped.
    """
    answers = filter_answers(postings)
    if strict:
        return answers.select(_answer_key(strict).alias("question_id"), F.col("id").alias("answer_id"),
                              F.col("score").alias("answer_score"))
    # drop parentless answers without a filter on the parsed parent: Catalyst would
    # push such a filter below the CSV parser and split every line again
    keep = F.when(F.col("parent_id").isNotNull(), F.array(F.struct(
        F.col("parent_id").alias("question_id"), F.col("id").alias("answer_id"),
        F.col("score").alias("answer_score"))))
    return answers.select(F.inline(keep))


def join_questions_answers(postings: DataFrame, *, strict: bool = True) -> DataFrame:
    """Inner equi-join: one row per (question, answer) pair.

    ``(question_id, q_accepted_answer, q_score, q_tags, answer_id, answer_score)``.
    Unanswered questions and orphan answers vanish; a repeated question id
    multiplies its pairs.  AQE picks broadcast vs sort-merge and splits skewed keys.
    """
    q = filter_questions(postings).select(
        F.col("id").alias("question_id"), F.col("accepted_answer").alias("q_accepted_answer"),
        F.col("score").alias("q_score"), F.col("tags").alias("q_tags"))
    a = answer_keys(postings, strict=strict).withColumnRenamed("question_id", "_key")
    # keys are never null here (a null id or, strictly, a null parent fails the job;
    # non-strict answer_keys drops null parents), so null-safe equality gives the same
    # pairs -- and, unlike ``=``, makes Catalyst infer no ``isnotnull`` filters, which it
    # would push below the CSV parser and evaluate by re-splitting every line
    return q.join(a, q["question_id"].eqNullSafe(a["_key"]), "inner").drop("_key")


def _cogrouped(postings: DataFrame, *, strict: bool, record: Column | None = None) -> DataFrame:
    """One row per question id that has both a question and an answer.

    A single aggregation over all postings, keyed by ``id`` for questions and by
    ``parent_id`` for answers (a co-group, not a join): one scan, one shuffle of
    partial aggregates, no pre-filter on the type -- Catalyst would push such a
    filter below the parser and re-run it.  Other posting types fall into a null
    key whose group is dropped.  Columns: ``question_id, n_questions, n_answers,
    max_answer_score, q`` (the smallest question ``record`` among equal ids).
    """
    record = F.struct("accepted_answer", "score", "tags") if record is None else record
    is_q = F.col("posting_type") == QUESTION_TYPE
    is_a = F.col("posting_type") == ANSWER_TYPE
    keyed = postings.select(
        F.when(is_q, F.col("id")).when(is_a, _answer_key(strict)).alias("question_id"),
        is_q.alias("_is_q"),
        (is_a & (F.col("parent_id").isNotNull() if not strict else F.lit(True))).alias("_is_a"),
        F.when(is_a, F.col("score")).alias("_a_score"),
        F.when(is_q, record).alias("_q"))
    return (keyed.groupBy("question_id")
            .agg(F.count_if("_is_q").alias("n_questions"), F.count_if("_is_a").alias("n_answers"),
                 F.max("_a_score").alias("max_answer_score"), F.min("_q").alias("q"))
            .where((F.col("n_questions") > 0) & (F.col("n_answers") > 0)))


def grouped_postings(postings: DataFrame, *, strict: bool = True) -> DataFrame:
    """Q&A grouped by question: ``(question_id, n_pairs)`` for every answered question.

    ``n_pairs`` = (#questions with that id) x (#answers to it), the size of the group
    the pairwise join would produce.  The pairs themselves are
    :func:`join_questions_answers`; they are never collected into one record.
    """
    return _cogrouped(postings, strict=strict).select(
        "question_id", (F.col("n_questions") * F.col("n_answers")).alias("n_pairs"))


def scored_postings(postings: DataFrame, *, strict: bool = True) -> DataFrame:
    """Best answer score per answered question, floored at 0.

    ``(question_id, accepted_answer, score, tags, high_score)``.  With a repeated
    question id the smallest question record is kept.
    """
    return _cogrouped(postings, strict=strict).select(
        "question_id",
        F.col("q.accepted_answer").alias("accepted_answer"),
        F.col("q.score").alias("score"),
        F.col("q.tags").alias("tags"),
        F.greatest(F.col("max_answer_score"), F.lit(0)).cast("int").alias("high_score"))


def _record_number(categories: Sequence[str]) -> Column:
    """A question's (accepted_answer, score, tag) as one decimal in the order of these records, nulls first.

    65 bits of the answer id, 33 of the score and 16 of the tag's code: 35 digits at most."""
    def digits(c: Column) -> Column:
        return c.cast("decimal(38,0)")

    accepted = F.coalesce(digits(F.col("accepted_answer")) + F.expr(f"cast({2**63 + 1}BD as decimal(38,0))"), digits(F.lit(0)))
    score = F.coalesce(F.col("score").cast("bigint") + F.lit(2**31 + 1), F.lit(0).cast("bigint"))
    low = score * F.lit(1 << 16) + tag_code("tags", categories)
    return digits(accepted * F.lit(1 << 49).cast("decimal(16,0)")) + digits(low)


def scored_vectors(postings: DataFrame, categories: Sequence[str], spread: int, *, strict: bool = True) -> DataFrame:
    """``vector_postings(scored_postings(...))`` in one hash aggregation.

    A vector needs of its question only the tag's category.  The question record, whose smallest counts where an id
    is repeated, is packed into one decimal in the order of the records, so every aggregation buffer has a
    fixed width: nothing is sorted, before or after the shuffle."""
    check_reach(categories, spread)
    if len(categories) >= 1 << 15:
        return vector_postings(scored_postings(postings, strict=strict), categories, spread, strict=strict)
    best = _cogrouped(postings, strict=strict, record=_record_number(categories))
    x = category_x_of_code((F.col("q") % F.lit(1 << 16)).cast("int"), categories, spread, strict=strict)
    out = best.select("question_id", x.alias("x"), F.greatest(F.col("max_answer_score"), F.lit(0)).cast("int").alias("y"))
    return out if strict else out.where(F.col("x").isNotNull())


def grouped_pair_lists(postings: DataFrame, *, max_list: int = 10_000, strict: bool = True) -> DataFrame:
    """Q&A grouped by question as bounded records.

    ``(question_id, part, n_parts, q_accepted_answer, q_score, q_tags, answers)`` where
    ``answers`` is ``array<struct<answer_id, answer_score>>`` sorted by id.  A question's
    answers are dealt by id (:func:`kestrel.functions.parts.dealt_part`) into
    ``n_parts = ceil(n_answers / max_list)`` parts (every pair kept).  Sizes come from the map-side-combined co-group.  Only questions
    of more than one part are looked up; their question rows are repeated once per part
    *before* the pairs are made, so the pairs are joined and grouped on (question_id, part)
    and a question owning a third of all answers is spread over its parts.
    """
    if max_list < 1:
        raise ValueError("max_list must be >= 1")
    hot = (_cogrouped(postings, strict=strict)
           .select(F.col("question_id").alias("_qid"), F.ceil(F.col("n_answers") / F.lit(max_list)).cast("int").alias("_n"))
           .where(F.col("_n") > 1))
    n_parts = F.coalesce("_n", F.lit(1)).alias("n_parts")
    q = filter_questions(postings).select(
        F.col("id").alias("question_id"), F.col("accepted_answer").alias("q_accepted_answer"),
        F.col("score").alias("q_score"), F.col("tags").alias("q_tags"))
    q = q.join(hot, q["question_id"].eqNullSafe(hot["_qid"]), "left").select("*", n_parts).drop("_qid", "_n")
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
    a = answer_keys(postings, strict=strict).withColumnRenamed("question_id", "_key")
    a = a.join(hot, a["_key"].eqNullSafe(hot["_qid"]), "left").select("*", n_parts).drop("_qid", "_n")
    a = a.select("_key", "answer_id", "answer_score", dealt_part("answer_id", "n_parts").alias("_part"))
    # null-safe key equality: no inferred isnotnull filter pushed below the parser
    pairs = q.join(a, q["question_id"].eqNullSafe(a["_key"]) & q["part"].eqNullSafe(a["_part"])).drop("_key", "_part")
    # a repeated question id has several question records: each gets its own lists
    return (pairs.groupBy("question_id", "part", "n_parts", "q_accepted_answer", "q_score", "q_tags")
            .agg(F.array_sort(F.collect_list(F.struct("answer_id", "answer_score"))).alias("answers")))


def with_category_index(postings: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Adds ``category`` (0-based index of the tag in ``categories``; null if missing/unknown)."""
    return postings.withColumn("category", category_index("tags", categories))


def vector_postings(scored: DataFrame, categories: Sequence[str], spread: int, *,
                    strict: bool = True) -> DataFrame:
    """``(question_id, x, y)`` with x = category index * spread, y = high score.

    Strict: a question whose tag is missing or unknown fails the job; otherwise it is dropped.
    """
    x = category_x("tags", categories, spread, strict=strict)
    out = scored.select("question_id", x.alias("x"), F.col("high_score").cast("int").alias("y"))
    return out if strict else out.where(F.col("x").isNotNull())
