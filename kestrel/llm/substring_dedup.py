"""Substring dedup by recompression: words of a document go that some document with a smaller doc_id says as well.

A window is ``WINDOW`` consecutive words of one document.  Recompression names runs and pairs of symbols
bottom-up: in every round first each maximal run of a symbol becomes one symbol, then each pair of a
left-hand and a right-hand symbol (a coin per symbol and round decides) does.  A name is a hash of what it
is made of, so equal runs and pairs get equal names in every task and every document.  For every symbol the
stretch of words that its existence depends on is tracked (its context); two windows with equal words hold
the same symbols wherever the context lies inside the window.  Every window chooses one such symbol by its words
alone (the highest round, then the smallest name); a window without any (long runs, short periods) stands for itself.

Spark rounds:
1. exact copies: of documents with the same text only the smallest doc_id goes on;
2. chosen symbols, by name: those of two or more documents reveal where repeats can be;
3. the windows that chose them are verified by 96 bits of content hash: a window repeats if a smaller doc_id
   has it; this covers every repeated window, since equal windows choose the same symbol (or stand for themselves);
4. repeated windows go back to their documents, which drop the words these cover.

Before the shuffles of rounds 2 and 3 every task packs the places of one document that share a symbol or window into one
row, and keeps, of a symbol or window, the row of its smallest doc_id under the key; later documents of the same task are
known to repeat and travel under keys of their own.  So a symbol or window in a third of all documents, or thousands of
times in one, is one row per task.  Texts are shuffled once, by doc_id, and that
exchange serves all three joins.

Defined cases: a null text has no words; null doc_ids come before all others (as the smallest); rows with the
same doc_id are one source, but each is cleaned by itself; windows never cross documents; a document of
fewer than ``WINDOW`` words keeps all; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kestrel.llm.bytesvec import IS_SPACE, SegmentHasher, chunks, lean, mix, ragged, utf8_of, word_segments
from kestrel.llm.common import bounded_batches, shuffle_partitions

WINDOW = 50
#: Rounds of naming: runs first, then pairs.
ROUNDS = 6
#: Symbols are considered from this round on; windows without any stand for themselves.
FIRST_LEVEL = 3
FIRST = SegmentHasher(4, IS_SPACE)
SECOND = SegmentHasher(44, IS_SPACE)
_U = np.uint64
NONE = np.iinfo(np.uint64).max
NULL_ID = -(1 << 63)
#: Row tag bits beside a window's start: rows that share a doc_id stay apart.
TAG_BITS = 24


def _name(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix(a * _U(0x9E3779B97F4A7C15) + mix(b + _U(salt)))


def _runs(name, end, cl, cr, row, far):
    """Name every maximal run of equal symbols; that a symbol stands alone depends on both neighbours."""
    n = len(name)
    same = row[1:] == row[:-1]
    head = np.r_[True, ~(same & (name[1:] == name[:-1]))]
    at = np.flatnonzero(head)
    last = np.r_[at[1:], n] - 1
    m = last - at + 1
    left_ok = (at > 0) & np.r_[False, same][at]
    right_ok = (last < n - 1) & np.r_[same, False][last]
    left, right = np.maximum(at - 1, 0), np.minimum(last + 1, n - 1)
    lo = np.where(left_ok, np.minimum(cl[left], cl[at]), -far)
    hi = np.where(right_ok, np.maximum(cr[right], cr[last]), np.iinfo(np.int64).max // 2)
    return np.where(m > 1, _name(name[at], m.astype(_U), 1), name[at]), end[last], lo, hi, row[at]


def _pairs(name, end, cl, cr, row, far, level):
    """Name every pair of a left-hand and a right-hand symbol; a symbol left over depends on one neighbour."""
    n = len(name)
    right_hand = (mix(name + _U(2 * level + 3)) & _U(1)).astype(bool)
    same = row[1:] == row[:-1]
    pair = np.r_[~right_hand[:-1] & right_hand[1:] & same, False]
    second = np.r_[False, pair[:-1]]
    nxt, prv = np.minimum(np.arange(n) + 1, n - 1), np.maximum(np.arange(n) - 1, 0)
    has_next, has_prev = np.r_[same, False], np.r_[False, same]
    lo, hi = cl.copy(), cr.copy()
    ahead = ~right_hand  # paired or not, a left-hand symbol looks ahead, a right-hand one behind
    lo[ahead] = np.where(has_next[ahead], np.minimum(cl[ahead], cl[nxt[ahead]]), cl[ahead])
    hi[ahead] = np.where(has_next[ahead], np.maximum(cr[ahead], cr[nxt[ahead]]), np.iinfo(np.int64).max // 2)
    hi[~ahead] = np.where(has_prev[~ahead], np.maximum(cr[~ahead], cr[prv[~ahead]]), cr[~ahead])
    lo[~ahead] = np.where(has_prev[~ahead], np.minimum(cl[~ahead], cl[prv[~ahead]]), -far)
    keep = np.flatnonzero(~second)
    other = np.minimum(keep + 1, n - 1)
    paired = pair[keep]
    return (np.where(paired, _name(name[keep], name[other], 2), name[keep]),
            np.where(paired, end[other], end[keep]), lo[keep], hi[keep], row[keep])


def symbols(names: np.ndarray, row: np.ndarray, window: int = WINDOW,
            rounds: int = ROUNDS) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, names, context begin, context end) of the symbols of each considered round whose context fits a window.

    ``names`` are the words' names, ``row`` their text; places count over all texts."""
    place = np.arange(len(names), dtype=np.int64)
    state = (names, place + 1, place, place + 1, row)
    out, far = [], 1 << 60
    for level in range(rounds):
        state = _pairs(*_runs(*state, far), far, level)
        if level + 1 >= FIRST_LEVEL:
            fits = np.flatnonzero(state[3] - state[2] <= window)
            out.append((level + 1, state[0][fits], state[2][fits], state[3][fits]))
    return out


def chosen_symbols(levels, valid: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The symbol that each window start chooses: that of the highest round, then of the smallest name, whose context
    lies inside the window; ``NONE`` without any.  The choice depends on the window's words only."""
    n = len(valid)
    top = max(level for level, *_ in levels)
    rank = np.concatenate([(_U(top - level) << _U(59)) | (names >> _U(5)) for level, names, _, _ in levels])
    begin, end = (np.concatenate([x[k] for x in levels]) for k in (2, 3))
    # a symbol covers the window starts [end - window, begin]: two blocks of a power of two, pushed down
    low = np.maximum(end - window, 0)
    log = np.int64(np.floor(np.log2(begin - low + 1))) if len(low) else low
    size = int(log.max(initial=0)) + 1
    tables = [np.full(n, NONE, dtype=np.uint64) for _ in range(size)]
    for k in range(size):
        own = log == k
        np.minimum.at(tables[k], low[own], rank[own])
        np.minimum.at(tables[k], begin[own] - (1 << k) + 1, rank[own])
    for k in range(size - 1, 0, -1):
        half = 1 << (k - 1)
        np.minimum(tables[k - 1], tables[k], out=tables[k - 1])
        np.minimum(tables[k - 1][half:], tables[k][:n - half], out=tables[k - 1][half:])
    return np.where(valid, tables[0], NONE)


class Words:
    """The words of a stretch of texts by their names, and the window hashes over them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
        self.starts, self.lengths, self.row = word_segments(data, offsets)
        self.window = window
        self.names = FIRST(data[self.starts[0]:], self.starts - self.starts[0], self.lengths) if len(self.starts) else \
            np.empty(0, np.uint64)
        self.data = data
        self.counts = np.bincount(self.row, minlength=len(offsets) - 1)
        self.before = np.cumsum(self.counts) - self.counts

    def valid(self) -> np.ndarray:
        """Places where a window of one text starts."""
        return np.arange(len(self.row)) + self.window <= (self.before + self.counts)[self.row]

    def window_hashes(self, at: np.ndarray, hasher: SegmentHasher | None = None) -> np.ndarray:
        """64-bit content hashes of the windows that start at ``at``: sums of word names times odd powers."""
        names = self.names if hasher is None else hasher(self.data[self.starts[0]:], self.starts - self.starts[0], self.lengths)
        total = np.zeros(len(at), dtype=np.uint64)
        factor, step = 1, 0xD1342543DE82EF95
        for k in range(self.window):
            total += names[at + k] * _U(factor)
            factor = factor * step % (1 << 64)
        return mix(total)


def _local(keys: np.ndarray, ids: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-aggregation within a task: (key, later, shared).  Rows of a key whose id is not the task's smallest for it
    are ``later`` and get a key of their own (``spread``), so a key crosses the shuffle from one document per task only;
    ``shared`` marks rows whose key has several ids here."""
    if not len(keys):
        return keys, np.empty(0, bool), np.empty(0, bool)
    order = np.lexsort((ids, keys))
    edge = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    sizes = np.diff(np.r_[edge, len(order)])
    low, high = np.repeat(ids[order][edge], sizes), np.repeat(ids[order][edge + sizes - 1], sizes)
    later, shared = np.empty(len(keys), bool), np.empty(len(keys), bool)
    later[order], shared[order] = ids[order] > low, high > low
    return np.where(later, spread, keys), later, shared


def _packed(keys: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """One row per key and id: (the index of its first place, its other places; null for a single place), in the order of
    these indices: neighbours of one document stay together, so that shuffled rows compress."""
    order = np.lexsort((places, ids, keys))
    head = np.r_[True, (np.diff(keys[order]) != 0) | (np.diff(ids[order]) != 0)]
    at = np.flatnonzero(head)
    others = np.diff(np.r_[at, len(order)]) - 1
    more = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(others)].astype(np.int32)),
                                    pa.array(places[order][~head]), mask=pa.array(others == 0))
    back = np.argsort(order[at])
    return order[at][back], more.take(pa.array(back))


def _batch(columns: list[np.ndarray | pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns],
        names=names)


def _all_places(first: str) -> Column:
    return F.flatten(F.collect_list(F.concat(F.array(first), F.coalesce("more", F.array().cast("array<long>")))))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8_of(batch.column(2))
    for i, j in chunks(offsets):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def _copied(batch: pa.RecordBatch) -> np.ndarray:
    """Rows whose text a smaller doc_id has as well (column 3 lists the doc_id's copied texts)."""
    return np.array([c is not None and t in c for t, c in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())],
                    dtype=bool)


def symbol_rows(batches: Iterator[pa.RecordBatch], window: int = WINDOW) -> Iterator[pa.RecordBatch]:
    """(key, id, run, more, shared): per doc_id the runs of windows that choose one symbol, the first and the others; a run
    packs first start and length."""
    held: list[list[np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            keys, ids, runs = (np.concatenate(c) for c in zip(*held))
            held.clear()
            at, more = _packed(keys, ids, runs)
            keys, ids = keys[at], ids[at]
            key, _, shared = _local(keys, ids, mix(keys * _U(3) + ids.astype(np.uint64)))
            yield _batch([key, ids, runs[at], more, shared], ["key", "id", "run", "more", "shared"])

    for batch in lean(batches):
        ids, copied = batch.column(0).to_numpy(zero_copy_only=False), _copied(batch)
        for i, j, data, offsets in _texts(batch):
            words = Words(data, offsets, window)
            valid = words.valid() & ~copied[i:j][words.row]
            if not valid.any():
                continue
            best = chosen_symbols(symbols(words.names, words.row, window), valid, window)
            bare = np.flatnonzero(valid & (best == NONE))
            head = np.flatnonzero((best != NONE) & np.r_[True, (best[1:] != best[:-1]) | (words.row[1:] != words.row[:-1])])
            # a run ends where the choice changes; windows of two texts never touch, as a text's last starts are invalid
            change = np.r_[np.flatnonzero(np.diff(best) != 0) + 1, len(best)]
            length = change[np.searchsorted(change, head, "right")] - head
            for first in range(0, 1 + int(length.max(initial=1)) // 64):
                part = length > 64 * first  # the length field holds up to 64
                start = np.r_[head[part] + 64 * first, bare if first == 0 else bare[:0]]
                size = np.r_[np.minimum(length[part] - 64 * first, 64), np.ones(len(bare) if first == 0 else 0, np.int64)]
                key = np.r_[best[head[part]], words.window_hashes(bare) if first == 0 else best[:0]]
                row = words.row[start]
                held.append([key, ids[i + row], ((start - words.before[row]) << 6) | (size - 1)])
        if sum(len(h[0]) for h in held) > 4_000_000:
            yield from flush()
    yield from flush()


def window_rows(batches: Iterator[pa.RecordBatch], window: int = WINDOW) -> Iterator[pa.RecordBatch]:
    """(h1, h2, id, spot, more, later): the windows of the runs in column 3, by content, with the first and the other
    places of a doc_id; a spot packs start and row tag."""
    held: list[list[np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            h1, h2, ids, spots = (np.concatenate(c) for c in zip(*held))
            held.clear()
            at, more = _packed(h1 ^ mix(h2), ids, spots)
            h1, h2, ids = h1[at], h2[at], ids[at]
            both = h1 ^ mix(h2)
            own, later, _ = _local(both, ids, mix(both * _U(3) + ids.astype(np.uint64)))
            yield _batch([np.where(later, own, h1), h2 >> _U(32), ids, spots[at], more, later],
                         ["h1", "h2", "id", "spot", "more", "later"])

    for batch in lean(batches):
        ids, tags = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        runs, run_of = batch.column(3).flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(
            batch.column(3).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
        for i, j, data, offsets in _texts(batch):
            words = Words(data, offsets, window)
            own = runs[run_of[i]:run_of[j]]
            row = np.repeat(np.arange(j - i), np.diff(run_of[i:j + 1]))
            size = (own & 63) + 1
            wanted = np.zeros(len(words.row) + 1, dtype=bool)
            start, row = ragged(own >> 6, size), np.repeat(row, size)
            inside = start + window <= words.counts[row]
            wanted[words.before[row[inside]] + start[inside]] = True
            at = np.flatnonzero(wanted)
            if len(at):
                row = words.row[at]
                spot = ((at - words.before[row]) << TAG_BITS) | (tags[i + row] & ((1 << TAG_BITS) - 1))
                held.append([words.window_hashes(at), words.window_hashes(at, SECOND), ids[i + row], spot])
        if sum(len(h[0]) for h in held) > 2_000_000:
            yield from flush()
    yield from flush()


def cleaned_rows(batches: Iterator[pa.RecordBatch], window: int = WINDOW, with_text: bool = False) -> Iterator[pa.RecordBatch]:
    """(id, n_words, n_removed, kept_sha256[, text]) of each text, without the words under its repeated windows."""
    for batch in lean(batches):
        copied = _copied(batch)
        out: list[tuple] = []
        for d, tag, text, spots, whole in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), copied):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            kept = words
            if whole and len(words) >= window:
                kept = []
            elif spots:
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.array([s >> TAG_BITS for s in spots if (s ^ tag) & ((1 << TAG_BITS) - 1) == 0], dtype=np.int64)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
                covered = np.cumsum(gone[:-1]) > 0
                kept = [w for w, c in zip(words, covered.tolist()) if not c]
            said = b" ".join(kept)
            out.append((d, len(words), len(words) - len(kept), hashlib.sha256(said).hexdigest())
                       + ((said.decode("utf-8", "surrogatepass"),) if with_text else ()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ["id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(5 if with_text else 4)],
                                         names=names[:5 if with_text else 4])


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text on request): one row per row of ``docs``."""
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_ID).cast("long")).alias("id"), F.xxhash64(body).alias("tag"),
                       body.alias("text"), F.xxhash64(F.lit(1), body).alias("tag2"))
    # 1. exact copies, by a 128-bit hash of the text
    first = rows.groupBy("tag", "tag2").agg(F.min("id").alias("first"))
    copies = (rows.select("id", "tag", "tag2").join(first, ["tag", "tag2"]).filter("first < id")
              .groupBy("id").agg(F.collect_set("tag").alias("copies")))
    texts = rows.select("id", "tag", "text").repartition(shuffle_partitions(docs), "id")

    def beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        # one small row per doc_id on the right: hashed per partition, the texts are not sorted
        return left.join(right.hint("shuffle_hash"), "id", how)

    # 2. symbols of several documents
    named = beside(texts, copies, "left").mapInArrow(
        lambda it: symbol_rows(it, window), "key long, id long, run long, more array<long>, shared boolean")
    over = W.partitionBy("key")
    runs = (named.withColumn("low", F.min("id").over(over)).withColumn("high", F.max("id").over(over))
            .filter("shared or low < high").groupBy("id").agg(_all_places("run").alias("runs")))
    # 3. windows that choose them, verified by content
    seen = beside(texts, runs, "inner").mapInArrow(
        lambda it: window_rows(it, window), "h1 long, h2 long, id long, spot long, more array<long>, later boolean")
    repeated = (seen.withColumn("low", F.min("id").over(W.partitionBy("h1", "h2"))).filter("later or low < id")
                .groupBy("id").agg(_all_places("spot").alias("spots")))
    # 4. what remains of each text
    joined = beside(beside(texts, copies, "left"), repeated, "left").select("id", "tag", "text", "copies", "spots")
    out = joined.mapInArrow(lambda it: cleaned_rows(it, window, with_text),
                            "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    return out.select(F.nullif("id", F.lit(NULL_ID).cast("long")).alias("doc_id"), *out.columns[1:])


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What every document keeps once words under repeated windows are gone."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (
  SELECT rid, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), rep AS (
  SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM win) WHERE low < doc_id
), cov AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS i FROM rep
), words AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), kept AS (
  SELECT words.rid, count(cov.i) AS n_removed,
         string_agg(words.word, ' ' ORDER BY words.i) FILTER (cov.i IS NULL) AS t
  FROM words LEFT JOIN cov ON words.rid = cov.rid AND words.i = cov.i GROUP BY words.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
