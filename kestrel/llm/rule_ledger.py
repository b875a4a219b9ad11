"""Quality rules as a bitmask ledger (DataFrame functions only).

``measure`` computes every measurement of a document once, ``ledger`` evaluates every rule once
and packs the failures into one ``bigint`` bitmask.  Policies are versioned masks over those bits,
so applying, comparing or ablating them never reads a text again: ``ablation`` first counts the
documents of each distinct mask (map-side combined, at most 2**rules rows) and derives every
policy's figures from those counts.

Defined cases: a null or empty text has no words, zero in every measurement and fails
``few_words``; repeated rows are judged one by one; other columns of ``docs`` are ignored; an
empty table gives an empty ledger.  Work per document is O(n log n) in its words and stays inside
its row, so no key can be hot and nothing is shuffled.  Windows are compared by the chained 64-bit
XXH64 of their eight words within one document only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import NON_SPACE, words_column

WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``fails`` is true where a document fails; it may read the measurement columns only."""

    name: str
    fails: Callable[[], Column]


#: The position in this list is the bit; append only, so that stored ledgers keep their meaning.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda: F.col("n_words") < 20),
    Rule("repeated_windows", lambda: F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")),
    Rule("symbols", lambda: F.lit(10) * F.col("n_symbols") > F.col("n_words")),
    Rule("duplicate_lines", lambda: F.lit(2) * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("short_words", lambda: F.col("word_chars") < F.lit(2) * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > F.lit(15) * F.col("n_words")),
    Rule("shouting", lambda: F.lit(5) * F.col("n_upper") > F.lit(2) * F.col("word_chars")),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words", "shouting"),
}
DEFAULT_POLICY = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(BIT[name] for name in set(rules))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the measurements: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_repeat_words (words covered by an 8-word window that occurs twice or more), n_upper."""
    t = F.coalesce(F.col(text), F.lit(""))
    without = t
    for symbol in SYMBOLS:
        without = F.replace(without, F.lit(symbol))
    base = docs.select("doc_id", t.alias("t"), words_column(t).alias("w"),
                       F.filter(F.split(t, "\n"), lambda x: x.rlike(NON_SPACE)).alias("lines"),
                       (F.length(t) - F.length(without)).cast("long").alias("n_symbols"),
                       F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long").alias("n_upper"))
    n = F.size("w")
    base = base.select(
        "doc_id", "n_symbols", "n_upper", n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                        lambda i: F.xxhash64(F.slice("w", i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")).alias("h"))
    # hashes with their positions, in hash order, only for documents that repeat a window at all
    base = base.withColumn("s", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    base = base.withColumn("p", F.sort_array(F.transform(F.filter("s", lambda e, j: F.coalesce(
        (F.get("s", j - 1)["x"] == e["x"]) | (F.get("s", j + 1)["x"] == e["x"]),
        F.get("s", j - 1)["x"] == e["x"], F.get("s", j + 1)["x"] == e["x"], F.lit(False))), lambda e: e["i"])))
    covered = F.aggregate(
        F.transform("p", lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get("p", k + 1) - v, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    return base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                       F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"), "n_upper")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set where rule i fails."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(BIT[rule.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, text).withColumn("fail_bits", bits)


def fails_policy(bits: Column, rules: tuple[str, ...]) -> Column:
    return bits.bitwiseAND(F.lit(mask_of(rules)).cast("long")) != 0


def apply_policy(led: DataFrame, policy: str = DEFAULT_POLICY,
                 policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` (a base failure always rejects)."""
    return (led.withColumn("base_failed", fails_policy(F.col("fail_bits"), policies["base"]))
            .withColumn("kept", ~fails_policy(F.col("fail_bits"), policies["base"])
                        & ~fails_policy(F.col("fail_bits"), policies[policy])))


def ablation(led: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per policy and rule of it: documents, kept, failing the rule, and failing nothing else (those that
    leaving the rule out would bring back); the union and intersection of all failure masks ride along."""
    counts = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    plan = [(version, rule, mask_of(rules), BIT[rule]) for version, rules in policies.items() for rule in rules]
    spec = F.explode(F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"),
                                        F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit"))
                               for v, r, m, b in plan]))
    hit = F.col("fail_bits").bitwiseAND(F.col("s.mask"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return (counts.select("fail_bits", "n", spec.alias("s")).groupBy("s.policy", "s.rule")
            .agg(F.sum("n").cast("long").alias("n_docs"), total(hit == 0).alias("n_kept"),
                 total(hit.bitwiseAND(F.col("s.bit")) != 0).alias("n_failed"),
                 total(hit == F.col("s.bit")).alias("n_only"),
                 F.bit_or("fail_bits").alias("any_bits"), F.bit_and("fail_bits").alias("all_bits")))


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         length(regexp_replace(t, '\P{Lu}+', '', 'g'))::BIGINT AS n_upper,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (rid) LEFT JOIN cov USING (rid)
), bits AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 5 * n_upper > 2 * word_chars THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 127) = 0 AS kept, fail_bits
FROM bits
"""


def op10_rule_ledger(spark, sf_dir: str) -> DataFrame:
    """Every document's measurements, failure bits and verdict under the default policy."""
    led = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return apply_policy(led).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed", "kept", "fail_bits")
