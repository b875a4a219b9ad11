"""Hard-negative mining by a secondary-sort shuffle.

For each anchor its ``positives`` nearest rows of the same label, and for each of these the ``negatives`` nearest rows of
other labels whose score lies in the positive's window: low * positive <= 100 * score <= high * positive (percent).
Scores are exact integer inner products of quantised vectors; higher scores come first, ties by smaller id.

* The rows are packed into blocks of ``BLOCK_ROWS`` quantised vectors and written once.  Every block meets every
  block of the anchors (the stated query set) in one matrix product; the blocks of a ``group`` of rows meet a copy
  of the anchors' blocks through a join on the group, so neither side is broadcast or collected.
* Pair scores are packed into keys of bytes, (anchor, descending score, id, kind, row), whose order is that of the
  bytes.  ``repartitionAndSortWithinPartitions`` deals them by anchor and sorts them; an iterator then reads
  each anchor's pairs best first and holds no more than the anchor's open windows and their counts.
* The first pass sorts the same-label pairs and keeps the first ones: the positives.  The second pass sends, for
  each positive, the pairs inside its window; as a positive passes by, its window opens, and each negative
  is emitted for the open windows that it lies in.
* Before a shuffle a task keeps of each anchor (and window) only its own best ``positives`` (``negatives``) pairs:
  no other can be among the best of all, so nothing is lost and an anchor's records do not grow with its rows.

Defined cases: a null label or vector, or a null or non-finite component, keeps a row out; a row with a null id is
never an anchor and comes last among ties; a row with an anchor's own id is no "other row" for it; rows that
repeat an anchor row (id, label, vector) are one anchor, while repeated candidates each have a place; vectors
of unequal length are compared as if padded with zeros; a positive with a negative score has an empty window;
a score beyond 64 bits fails the job; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import lean
from kestrel.llm.common import bounded_batches, shuffle_partitions
from kestrel.session import materialize

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SCALE = 256
BLOCK_ROWS = 2048
ANCHOR_ROWS = 512
#: Blocks of rows per group, beyond one group for each shuffle partition.
GROUP_BLOCKS = 256
#: Integers up to here are exact in a double.
EXACT = 1 << 53
NULL_ID = -(1 << 63)
SIGN = 1 << 63
KEY = ">QQQBQBQ"  # anchor id, anchor content, descending score, null id, id, kind, row
ANCHOR_BYTES = 16
POSITIVE, NEGATIVE = 0, 1
BLOCK = "block string, first long, n int, width int, narrow boolean, ids binary, labels binary, vectors binary"
NAMES = [c.split()[0] for c in BLOCK.split(", ")]
BLOCK_FIELDS = [("block", pa.string()), ("first", pa.int64()), ("n", pa.int32()), ("width", pa.int32()),
                ("narrow", pa.bool_()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())]
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix): the vectors without null or non-finite components as floor(scale * x), padded with zeros."""
    column = column.cast(pa.large_list(pa.float64()))
    there = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(there, np.diff(column.offsets.to_numpy()), 0)
    flat = column.flatten().to_numpy(zero_copy_only=False)  # leaves null vectors out; null components are NaN
    start = np.cumsum(sizes) - sizes
    bad = np.add.reduceat(np.r_[~np.isfinite(flat), False], np.minimum(start, len(flat)), dtype=np.int64)
    rows = np.flatnonzero(there & ((sizes == 0) | (bad == 0)))
    out = np.zeros((len(rows), int(sizes[rows].max(initial=0))))
    place = np.arange(out.shape[1])
    filled = place < sizes[rows][:, None]
    out[filled] = np.floor(scale * flat[(start[rows][:, None] + place)[filled]])
    return rows, out


def _packed(block: str, first: int, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> dict:
    """A BLOCK row: components of two bytes where all fit, else doubles, which hold a floor exactly."""
    narrow = bool(np.abs(matrix).max(initial=0) < 1 << 15)
    body = matrix.astype("<i2" if narrow else "<f8").tobytes()
    parts = ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), body
    return dict(zip(NAMES, (block, first, *matrix.shape, narrow, *parts)))


def _unpacked(rows: dict, head: str = "") -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(number of the first row, ids, labels, matrix) of a block whose columns begin with ``head``."""
    first, n, width, narrow, ids, labels, body = (rows[head + c] for c in NAMES[1:])
    matrix = np.frombuffer(body, "<i2" if narrow else "<f8").reshape(n, width).astype(np.float64)
    return first, np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), matrix


def blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """BLOCK rows of ``rows`` (id, label, vector): each partition packs and numbers its own rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(parts: list, all_rows: bool) -> Iterator[pa.RecordBatch]:
            width = max(m.shape[1] for _, _, m in parts)
            matrix = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, _, m in parts])
            ids, labels = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            whole = len(ids) if all_rows else len(ids) // block_rows * block_rows
            for i in range(0, whole, block_rows):
                own = np.arange(i, min(i + block_rows, whole))
                own = own[np.lexsort((ids[own], ids[own] == NULL_ID))]  # by id, null last
                row = _packed(str(number[0]), number[0], ids[own], labels[own], matrix[own])
                yield pa.RecordBatch.from_pylist([row], schema)
                number[0] += len(own)
            parts[:] = [(ids[whole:], labels[whole:], matrix[whole:])] if whole < len(ids) else []

        number = [TaskContext.get().partitionId() << 40]
        parts: list = []
        for batch in lean(batches):
            own, matrix = quantised(batch.column(2))
            if len(own):
                ids, labels = (batch.column(k).fill_null(NULL_ID).to_numpy()[own] for k in (0, 1))
                parts.append((ids, labels, matrix))
                if sum(len(p[0]) for p in parts) >= block_rows:
                    yield from cut(parts, False)
        if parts:
            yield from cut(parts, True)

    schema = pa.schema(BLOCK_FIELDS)
    return rows.filter("label is not null and vector is not null").select("id", "label", "vector").mapInArrow(pack, BLOCK)


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    out = [[sum(x * y for x, y in zip(r, s)) for s in whole[1]] for r in whole[0]]
    if any(not -SIGN < x < SIGN for row in out for x in row):
        raise OverflowError("an inner product does not fit 64 bits")
    return np.array(out, dtype=np.int64).reshape(len(a), len(b))


def in_window(score, positive, low: int = LOW, high: int = HIGH):
    """low * positive <= 100 * score <= high * positive, without overflow of 64 bits."""
    return (score >= -(-low * positive // 100)) & (score <= high * positive // 100)


def _best(scores: np.ndarray, take: int) -> np.ndarray:
    """Places of the ``take`` highest scores, ties to the earlier place."""
    if len(scores) <= take:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - take)[len(scores) - take]
    above = np.flatnonzero(scores > least)
    return np.r_[above, np.flatnonzero(scores == least)[:take - len(above)]]


def _descending(score: int) -> int:
    return SIGN - 1 - score  # 0 for the highest


def packed_key(anchor: int, content: int, score: int, own: int, kind: int, row: int = 0) -> bytes:
    return struct.pack(KEY, anchor + SIGN, content + SIGN, _descending(score), own == NULL_ID, own + SIGN, kind, row)


def _anchor_of(key: bytes) -> bytes:
    return key[:ANCHOR_BYTES]


def _read(key: bytes) -> tuple[int | None, int, int]:
    """(id, score, kind) of a packed key."""
    _, _, descending, null, own, kind, _ = struct.unpack(KEY, key)
    return None if null else own - SIGN, SIGN - 1 - descending, kind


class _Kept:
    """The best pairs of each (anchor, window) that a task has seen for one block of anchors."""

    def __init__(self, take: int):
        self.take, self.found = take, {}

    def offer(self, slot: tuple, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Of a block whose rows stand by id, the pairs of some places."""
        at = _best(scores, self.take)
        scores, ids, rows = scores[at], ids[at], rows[at]
        if slot in self.found:
            scores, ids, rows = (np.r_[x, y] for x, y in zip(self.found[slot], (scores, ids, rows)))
            by = np.lexsort((rows, ids, ids == NULL_ID, -scores))[:self.take]
            scores, ids, rows = scores[by], ids[by], rows[by]
        if len(ids):
            self.found[slot] = scores, ids, rows

    def keys(self) -> list[bytes]:
        """The pairs' keys; a pair in several windows has one."""
        return list({packed_key(*slot[:2], s, i, slot[2], r) for slot, kept in self.found.items()
                     for s, i, r in zip(*(x.tolist() for x in kept))})


def _keys(keys: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])


def pair_keys(rows: DataFrame, anchors: DataFrame, groups: int, positives: int, negatives: int, low: int,
              high: int) -> DataFrame:
    """``key``: packed pairs.  ``anchors`` are BLOCK rows and ``content`` (a list per anchor) and ``windows`` (the scores
    of each anchor's positives, null in the first pass, which yields pairs of kind POSITIVE)."""
    # equal shares of the blocks, spread as they come; the anchors' blocks go to every group
    grouped = rows.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups))).repartition(groups, "grp")
    copies = anchors.select(F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("grp"),
                            *(F.col(c).alias(f"a_{c}") for c in NAMES), "content", "windows").repartition(groups, "grp")
    met = copies.join(grouped, "grp").drop("grp")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def offer(pair: dict) -> None:
            _, a_ids, a_labels, a = _unpacked(pair, "a_")
            first, ids, labels, b = _unpacked(pair)
            numbers = first + np.arange(len(ids))
            for i, line in enumerate(scores_of(a, b)):
                slot, same = (int(a_ids[i]), pair["content"][i]), labels == a_labels[i]
                if pair["windows"] is None:
                    at = np.flatnonzero(same & (ids != a_ids[i]))
                    kept.offer((*slot, POSITIVE), line[at], ids[at], numbers[at])
                    continue
                for window in set(pair["windows"][i]):
                    at = np.flatnonzero(~same & (ids != a_ids[i]) & in_window(line, window, low, high))
                    kept.offer((*slot, NEGATIVE, window), line[at], ids[at], numbers[at])

        kept, now = _Kept(0), None
        for batch in lean(batches):
            for pair in batch.to_pylist():
                if now != pair["a_block"]:  # a block of anchors meets all its rows in turn; if not, more pairs are sent
                    yield _keys(kept.keys())
                    now, kept = pair["a_block"], _Kept(positives if pair["windows"] is None else negatives)
                offer(pair)
        yield _keys(kept.keys())

    return met.mapInArrow(score, "key binary")


def sorted_by_anchor(keys: DataFrame, partitions: int):
    """The packed keys as an RDD, each anchor's in one partition and in the order of the bytes: best pairs first."""
    def place(key: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(key[:ANCHOR_BYTES], digest_size=8).digest(), "big")

    return (keys.rdd.map(lambda r: (bytes(r[0]), None))
            .repartitionAndSortWithinPartitions(partitions, place).map(lambda kv: kv[0]))


def first_positives(keys: Iterator[bytes], positives: int) -> Iterator[tuple[int, int, list, list]]:
    """(anchor, content, ids, scores) of each anchor's first pairs."""
    for head, pairs in groupby(keys, _anchor_of):
        ids, scores = [], []
        for key in pairs:
            if len(ids) < positives:
                own, score, _ = _read(key)
                ids.append(own)
                scores.append(score)
        anchor, content = struct.unpack(">QQ", head)
        yield anchor - SIGN, content - SIGN, ids, scores


def windowed_negatives(keys: Iterator[bytes], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive's score, negative's score), an anchor's pairs read best first.

    A window opens when its positive passes by.  All its negatives come later, but for a positive of score 0,
    whose window holds that score alone: the first negatives of the present score are kept for it."""
    for head, pairs in groupby(keys, _anchor_of):
        anchor = struct.unpack(">QQ", head)[0] - SIGN
        windows: list[list] = []  # positive, its score, negatives so far
        level: list[tuple] = []  # the first negatives of the present score
        now = None
        for key in pairs:
            own, score, kind = _read(key)
            if score != now:
                now, level = score, []
            if kind == POSITIVE:
                window = [own, score, 0]
                windows.append(window)
                for earlier, s in level:
                    if in_window(s, score, low, high):
                        window[2] += 1
                        yield anchor, own, window[2], earlier, score, s
                continue
            if len(level) < negatives:
                level.append((own, score))
            for window in windows:
                if window[2] < negatives and in_window(score, window[1], low, high):
                    window[2] += 1
                    yield anchor, window[0], window[2], own, window[1], score


def anchor_blocks(anchors: DataFrame) -> DataFrame:
    """BLOCK rows, content and windows of at most ANCHOR_ROWS anchors each, of (id, label, vector, content, windows)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for i in range(0, batch.num_rows, ANCHOR_ROWS):
                part = batch.slice(i, ANCHOR_ROWS)
                own, matrix = quantised(part.column(2))
                if len(own):
                    ids, labels, contents = (part.column(k).to_numpy()[own] for k in (0, 1, 3))
                    windows = part.column(4).take(pa.array(own)).to_pylist()
                    name = hashlib.sha256(ids.tobytes() + contents.tobytes()).hexdigest()
                    row = _packed(name, 0, ids, labels, matrix)
                    row |= {"content": contents.tolist(), "windows": None if windows[0] is None else windows}
                    yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([*BLOCK_FIELDS, ("content", pa.list_(pa.int64())), ("windows", pa.list_(pa.list_(pa.int64())))])
    return anchors.select("id", "label", "vector", "content", "windows").mapInArrow(
        pack, f"{BLOCK}, content array<long>, windows array<array<long>>")


def hard_negatives(rows: DataFrame, is_anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """OUT rows of ``rows`` (id, label, vector); ``is_anchor`` (over these columns) picks the anchors.

    ``low`` and ``high`` are percentages, 0 <= low <= high < 100: a window then lies below its positive."""
    if not 0 <= low <= high < 100:
        raise ValueError("0 <= low <= high < 100 is needed")
    spark = rows.sparkSession
    bounded_batches(spark)
    n = shuffle_partitions(rows)
    packed = materialize(blocks(rows, BLOCK_ROWS), "negatives-rows")
    # distinct anchors; content tells anchors of one id apart
    chosen = (rows.filter(is_anchor & F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
              .dropDuplicates(["id", "label", "vector"])
              .select("id", "label", "vector", F.xxhash64("label", "vector").alias("content")))
    chosen = materialize(chosen, "negatives-anchors")
    groups = max(n, -(-packed.count() // GROUP_BLOCKS))

    args = groups, positives, negatives, low, high
    same = pair_keys(packed, anchor_blocks(chosen.withColumn("windows", F.lit(None).cast("array<long>"))), *args)
    best = sorted_by_anchor(same, n).mapPartitions(lambda keys: first_positives(keys, positives))
    best = materialize(spark.createDataFrame(best, "id long, content long, positives array<long>, windows array<long>"),
                       "negatives-positives")

    def own_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _keys([packed_key(r["id"], r["content"], s, NULL_ID if i is None else i, POSITIVE)
                         for r in batch.to_pylist() for i, s in zip(r["positives"], r["windows"])])

    inside = pair_keys(packed, anchor_blocks(chosen.join(best, ["id", "content"])), *args)
    pairs = inside.unionByName(best.mapInArrow(own_pairs, "key binary"))
    found = sorted_by_anchor(pairs, n).mapPartitions(lambda keys: windowed_negatives(keys, negatives, low, high))
    return spark.createDataFrame(found, OUT)


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with some labels moved on."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.expr("case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else cast(label as bigint) end")
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


#: DuckDB twin; lists are padded by leaving missing components out of the sum.
OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         embedding, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT *, row_number() OVER () AS anchor FROM (
  SELECT DISTINCT r.* FROM r WHERE vec_id % 100 = 0)),
pairs AS (
  SELECT a.anchor, a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, r.q, true), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM a JOIN r ON r.vec_id IS DISTINCT FROM a.vec_id),
pos AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST) AS k FROM pairs WHERE same),
hits AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.id NULLS LAST) AS rank
  FROM pos p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same AND p.k <= 5
   AND 30 * CAST(p.score AS HUGEINT) <= 100 * CAST(n.score AS HUGEINT)
   AND 100 * CAST(n.score AS HUGEINT) <= 90 * CAST(p.score AS HUGEINT))
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM hits WHERE rank <= 10
"""
