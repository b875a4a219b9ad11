"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a reproducible order, are cut into blocks of ``block_docs``.  Time runs in
slots of one block.  In a period a source with weight k (a whole number of parts) owns k of the D slots, D
being the parts of all sources that still have blocks; its block j is released at floor(j D / k) and due
at ceil((j + 1) D / k), and the slots go to the released block with the earliest deadline.  With whole
windows and full use, earliest deadline first meets every deadline, so while all its sources are alive no
source is a whole block away from its share after any number of slots.  A period ends with all sources exactly on target; a source
that runs dry leaves, and the others go on with their own weights, so every document gets a place.

Only one schedule per set of remaining sources is computed: sources leave one after the other, so there are
at most twice as many schedules as sources.  They have no more rows than there are blocks and are tables
throughout: Spark lays out the schedules (one task per schedule at a time, which holds one period), spells
out the slot of every block, and joins the slots to the documents per hash bucket of about ``BUCKET_DOCS``
documents.  The driver only sees sums, so neither the sources nor the rows of the table have a bound.

Defined cases: a null source is a source of its own; sources without a target weight get
``default_parts``; a weight of 0 puts a source's documents after all others; null and empty texts are
documents like others; repeated rows have places of their own, next to each other; null doc_ids of a source
count as equal, and rows of equal doc_id are numbered in one task (a bucket is chosen by the doc_id); other
columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from fractions import Fraction
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kestrel.llm.common import shuffle_partitions
from kestrel.session import materialize

BLOCK_DOCS = 16
#: Most parts in a period.  Weights whose ratios are whole numbers up to this total are taken as they are; others (and the
#: roots that are the default) are rounded to 1 / PARTS, so a share is off by at most half of that.
PARTS = 10_000
#: Target weight of a source is its share of documents to this power, unless weights are given.
TEMPERATURE = 0.5
BUCKET_DOCS = 10_000
#: Periods of a schedule that one row spells out, and slots that one window sums up.
PERIODS = 256
RUN_SLOTS = 10_000


def parts_of(weights: Mapping[str | None, float], parts: int = PARTS) -> dict[str | None, int]:
    """Whole parts: the exact ratio of the weights (as written in decimals) if it has ``parts`` in all at most, else about
    ``parts``, where a positive weight gets one part at least."""
    exact = {s: Fraction(str(w)) for s, w in weights.items() if w > 0}
    scale = math.lcm(*(f.denominator for f in exact.values()))
    whole = {s: int(f * scale) for s, f in exact.items()}
    unit = math.gcd(*whole.values())
    if sum(whole.values()) > parts * unit:
        total = sum(exact.values())
        whole, unit = {s: max(1, round(parts * f / total)) for s, f in exact.items()}, 1
    return {s: whole.get(s, 0) // (unit or 1) for s in weights}


def windows(k: int, slots: int) -> list[tuple[int, int]]:
    """(release, deadline) of the k blocks of a source in a period of ``slots``."""
    return [(j * slots // k, -(-(j + 1) * slots // k)) for j in range(k)]


def period(active: Mapping[str | None, int]) -> list[tuple[str | None, int, int, int]]:
    """Earliest deadline first over one period: (source, block, release, deadline) slot by slot."""
    slots = sum(active.values())
    names = sorted(active, key=lambda s: (s is None, s or ""))
    coming: list[list[tuple[int, int, int, int]]] = [[] for _ in range(slots)]
    for i, s in enumerate(names):
        for j, (release, due) in enumerate(windows(active[s], slots)):
            coming[release].append((due, i, j, release))
    ready: list[tuple[int, int, int, int]] = []
    out = []
    for t in range(slots):
        for job in coming[t]:
            heappush(ready, job)
        due, i, j, release = heappop(ready)  # full use: a released block is always waiting
        if due <= t:
            raise AssertionError("a deadline was missed")
        out.append((names[i], j, release, due))
    return out


PLAN = "s string, j long, k long, n long, first long, last long, base long, step long, at long, release long, deadline long"


def _lay_out(group: pa.Table) -> pa.Table:
    """The schedule (PLAN) of the periods ``first`` to ``last`` from the sources that still have blocks in them."""
    own = {r["s"]: r for r in group.to_pylist()}
    one = next(iter(own.values()))
    # in its last period a source may have fewer blocks than parts: its other slots fall away
    here = [x for x in period({s: r["k"] for s, r in own.items()})
            if one["first"] * own[x[0]]["k"] + x[1] < own[x[0]]["blocks"]]
    s, j, release, due = ([x[c] for x in here] for c in range(4))
    same = [[one[c]] * len(here) for c in ("first", "last", "base", "step")]
    columns = [j, [own[x]["k"] for x in s], [own[x]["n"] for x in s], *same, range(len(here)), release, due]
    return pa.Table.from_arrays([pa.array(s, pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                                names=[c.split()[0] for c in PLAN.split(", ")])


def _key(source: Column) -> Column:
    """A key that is never null; the null source comes last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def _sources(counts: DataFrame, weights: Mapping[str | None, float] | None, parts: int, default_parts: int,
             block_docs: int) -> DataFrame:
    """s, n (documents), k (parts), blocks: one row per source."""
    found = counts.groupBy("s").agg(F.sum("n").alias("n"))
    if weights is None:
        total = counts.agg(F.sum("n")).first()[0] or 1
        found = found.withColumn("w", F.pow(F.col("n") / total, F.lit(TEMPERATURE)))
        # a decimal sum does not depend on the order of its rows
        whole = float(found.agg(F.sum(F.col("w").cast("decimal(38,18)"))).first()[0] or 1)
        found = found.withColumn("k", F.greatest(F.lit(1), F.rint(parts * F.col("w") / whole).cast("long"))).drop("w")
    else:
        shares = [("1" if s is None else "0" + s, k) for s, k in parts_of(weights, parts).items()]
        given = counts.sparkSession.createDataFrame(shares, "s string, k long")
        found = found.join(given, "s", "left").withColumn("k", F.coalesce("k", F.lit(default_parts)))
    return materialize(found.selectExpr("s", "n", "cast(k as long) k", f"(n + {block_docs - 1}) div {block_docs} blocks"),
                       "mix-sources")


def _plan(sources: DataFrame) -> DataFrame:
    """PLAN rows: block j of a source's period p, first <= p < last, has the slot base + (p - first) * step + at."""
    live = sources.filter("k > 0").withColumn("until", F.expr("(blocks + k - 1) div k"))
    first = W.orderBy("first")
    cuts = (live.select(F.explode(F.array(F.expr("blocks div k"), "until")).alias("first"))
            .union(sources.sparkSession.range(1)).distinct())
    cuts = materialize(cuts.select("first", F.lead("first").over(first).alias("last"),
                                   (F.row_number().over(first) - 1).alias("cut")), "mix-cuts")
    # a source is active up to its own last cut
    active = live.join(cuts.select(F.col("first").alias("until"), F.col("cut").alias("upto")), "until")
    active = active.select("s", "n", "k", "blocks", F.explode(F.sequence(F.lit(0), F.col("upto") - 1)).alias("cut"))
    active = materialize(active.join(cuts, "cut"), "mix-active")
    steps = active.groupBy("cut", "first", "last").agg(
        F.sum(F.least("k", F.expr("blocks - first * k"))).alias("step"))
    slots = (F.col("last") - F.col("first")) * F.col("step")
    earlier = W.orderBy("cut").rowsBetween(W.unboundedPreceding, -1)
    steps = materialize(steps.select("cut", "step", slots.alias("slots"),
                                     F.coalesce(F.sum(slots).over(earlier), F.lit(0)).alias("base")), "mix-steps")
    plan = active.join(steps.drop("slots"), "cut").groupBy("cut").applyInArrow(_lay_out, PLAN)
    end = steps.agg(F.sum("slots")).first()[0] or 0
    before = F.sum("blocks").over(W.orderBy("s").rowsBetween(W.unboundedPreceding, -1))
    after = sources.filter("k = 0").withColumn("base", F.coalesce(before, F.lit(0)) + end)
    return plan.unionByName(after.selectExpr("s", "0L j", "1L k", "n", "0L first", "blocks last", "base", "1L step", "0L at",
                                             "0L release", "0L deadline"))


def _slots(sources: DataFrame, block_docs: int) -> DataFrame:
    """s, block, slot, release, deadline, start (place of its first document): one row per block."""
    n = shuffle_partitions(sources)
    spread = _plan(sources).withColumn("chunk", F.explode(F.expr(
        f"sequence(first div {PERIODS}, (last - 1) div {PERIODS})"))).repartition(n, "s", "j", "chunk")
    each = spread.withColumn("p", F.explode(F.expr(
        f"sequence(greatest(first, chunk * {PERIODS}), least(last, (chunk + 1) * {PERIODS}) - 1)")))
    # only the last block of a source may be short
    each = materialize(each.selectExpr(
        "s", "p * k + j block", "base + (p - first) * step + at slot", "release", "deadline",
        f"least({block_docs}, n - (p * k + j) * {block_docs}) size").withColumn("run", F.expr(f"slot div {RUN_SLOTS}")),
        "mix-slots")
    earlier = W.rowsBetween(W.unboundedPreceding, -1)
    runs = each.groupBy("run").agg(F.sum("size").alias("size"))
    runs = runs.select("run", F.coalesce(F.sum("size").over(earlier.orderBy("run")), F.lit(0)).alias("docs"))
    within = F.sum("size").over(earlier.partitionBy("run").orderBy("slot"))
    return (each.withColumn("within", F.coalesce(within, F.lit(0))).join(runs, "run")
            .selectExpr("s", "block", "slot", "release", "deadline", "docs + within start"))


def _placed(docs: DataFrame, weights: Mapping[str | None, float] | None, parts: int, default_parts: int,
            block_docs: int, seed: int) -> DataFrame:
    """row (struct of all columns), doc_id, source, block, release, deadline, slot, place.

    The order within a source is by a hash of the doc_id; its leading bits are the buckets.  A row's number in
    the source is its number within the bucket plus the rows of the source's earlier buckets.  A bucket meets
    the slots of its blocks as one list, so the documents are shuffled once, for their numbers."""
    rows = docs.select("source", "doc_id", F.struct(*docs.columns).alias("row"), _key(F.col("source")).alias("s"))
    bits = max(0, (max(1, rows.count()) - 1) // BUCKET_DOCS).bit_length()
    keyed = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 1))
    keyed = keyed.withColumn("bucket", F.shiftright("h", 63 - bits))
    counts = materialize(keyed.groupBy("s", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    slots = _slots(_sources(counts, weights, parts, default_parts, block_docs), block_docs)
    earlier = W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    spans = counts.select("s", "bucket", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    spans = spans.select("s", "bucket", "before", F.explode(F.expr(
        f"sequence(before div {block_docs}, (before + n - 1) div {block_docs})")).alias("block"))
    spans = spans.join(slots, ["s", "block"]).groupBy("s", "bucket").agg(
        F.first("before").alias("before"),
        F.array_sort(F.collect_list(F.struct("block", "slot", "release", "deadline", "start"))).alias("spots"))
    within = W.partitionBy("s", "bucket").orderBy("h", "doc_id")
    ranked = keyed.withColumn("rank", F.row_number().over(within) - 1).join(spans, ["s", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    spot = F.get("spots", F.expr(f"cast(rank div {block_docs} - before div {block_docs} as int)"))
    return (ranked.select("row", "doc_id", "source", "rank", spot.alias("spot"))
            .select("row", "doc_id", "source", "spot.block", "spot.release", "spot.deadline", "spot.slot",
                    (F.col("spot.start") + F.pmod("rank", F.lit(block_docs))).cast("long").alias("place")))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, parts: int = PARTS,
        default_parts: int = 1, block_docs: int = BLOCK_DOCS, seed: int = 0) -> DataFrame:
    """doc_id, source, block, release, deadline, slot, place: one row per row of ``docs``.

    ``place`` is the document's position in the mixture (0-based, no gaps), ``slot`` that of its block; release
    and deadline are slots within the block's period."""
    return _placed(docs.select("doc_id", "source"), weights, parts, default_parts, block_docs, seed).drop("row")


def in_mixed_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, parts: int = PARTS,
                   default_parts: int = 1, block_docs: int = BLOCK_DOCS, seed: int = 0) -> DataFrame:
    """``docs`` (all rows and columns), its partitions and the rows within them in the order of the mixture."""
    placed = _placed(docs, weights, parts, default_parts, block_docs, seed)
    return (placed.select("row", "place").repartitionByRange(shuffle_partitions(docs), "place")
            .sortWithinPartitions("place").select("row.*"))


def op1_pfair_mix(spark, sf_dir: str) -> DataFrame:
    """Place of every document in a mixture of all sources, weights by the square root of their sizes."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
