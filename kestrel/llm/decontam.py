"""Benchmark decontamination: rare n-gram seeds join passages to test items, local alignment scores them.

Words are runs of letters, digits and non-ASCII bytes, A-Z lowered.  A seed is an n-gram of ``SEED``
consecutive words of an item whose probability by the corpus's own word counts (one pass over all
documents) is at most ``RARE``; an item's rarer half always seeds it.  Probability, not the n-gram's
own count, decides: a leaked passage stays a seed however often it was leaked.  Around every seed hit the
passage and the item are aligned (Smith-Waterman over words: match +2, mismatch -1, gap -1) and the
score is the share of the item's best possible score.  Windows whose common words cannot reach the
threshold are skipped, which loses nothing: no alignment scores more than its matches.

A passage of ``RUN`` consecutive words of an item is a leak however small its share of the item, and its row
has the alignment's true score, below the threshold: hashes of all such runs are looked up at every word.
Items of fewer than ``MIN_WORDS`` words are looked up whole, if chance (at most ``RARE``) does not explain a match.

The items are the query set: they go to the tasks in blocks of at most about ``BLOCK_WORDS`` words, one
pass over the documents per block, so what travels with a task is bounded whatever the table's size.
Repeated rows of the benchmark travel once.

Defined cases: null, empty and blank texts match nothing; items of fewer than ``MIN_WORDS`` words that are not
rare give no result (they would match by chance); letters of a script without spaces are one word; repeated documents are judged one by one, repeated items once (one result row
per document row and item_id, the best score of equal item_ids); null ids are carried; other columns
are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import SegmentHasher, chunks, lean, utf8_of
from kestrel.llm.common import bounded_batches

SEED = 3
#: Chance of an n-gram per word of the corpus below which it is rare.
RARE = 1e-8
MIN_WORDS = 6
THRESHOLD = 0.5
#: Consecutive words of an item that are a leak by themselves.
RUN = 13
BLOCK_WORDS = 2_000_000

_CODES = np.arange(256)
BLANK = ~((_CODES >= 48) & (_CODES <= 57) | (_CODES >= 65) & (_CODES <= 90) | (_CODES >= 97) & (_CODES <= 122)
          | (_CODES >= 0x80))
FOLD = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
HASHER = SegmentHasher(9, BLANK)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each text)."""
    solid = ~BLANK[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = offsets[:-1] < offsets[1:]
    first[offsets[:-1][full]] = solid[offsets[:-1][full]]
    last[offsets[1:][full] - 1] = solid[offsets[1:][full] - 1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(offsets), dtype=np.int64)
    lengths = np.flatnonzero(last) + 1 - starts
    return HASHER(FOLD[data[starts[0]:]], starts - starts[0], lengths), np.searchsorted(starts, offsets)


@dataclass(frozen=True)
class Items:
    """A block of items: words as places in ``vocab`` (sorted word hashes)."""

    ids: list
    words: list[np.ndarray]
    vocab: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the vocabulary, -1 if it has none."""
        if not len(self.vocab):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where(self.vocab[at] == hashes, at, -1)


def item_block(rows: list) -> Items:
    data, offsets = utf8_of(pa.array([r["text"] for r in rows], pa.string()))
    hashes, before = word_hashes(data, offsets)
    keep = [i for i in range(len(rows)) if before[i + 1] > before[i]]
    vocab = np.unique(np.concatenate([hashes[before[i]:before[i + 1]] for i in keep] or [np.empty(0, np.uint64)]))
    return Items([rows[i]["item_id"] for i in keep],
                 [np.searchsorted(vocab, hashes[before[i]:before[i + 1]]) for i in keep], vocab)


def word_counts(docs: DataFrame, items: Items, text: str = "text") -> tuple[np.ndarray, int]:
    """Occurrences of each vocabulary word in all documents, and all words (counted per task, then summed)."""
    bounded_batches(docs.sparkSession)
    size = len(items.vocab)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, dtype=np.int64)
        for batch in lean(batches):
            data, offsets = utf8_of(batch.column(0))
            for i, j in chunks(offsets):
                hashes, _ = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                at = items.places(hashes)
                total += np.bincount(np.where(at < 0, size, at), minlength=size + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["word", "n"])

    out = np.zeros(size + 1, dtype=np.int64)
    for r in docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[r["word"]] = r["n"]
    return out[:-1], int(out.sum())


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Key of the n-gram at each place; -1 where a word has none."""
    if len(words) < SEED:
        return np.empty(0, np.int64)
    parts = [words[k:len(words) - SEED + 1 + k] for k in range(SEED)]
    key = parts[0].copy()
    for p in parts[1:]:
        key = key * np.int64(size) + p
    return np.where(np.minimum.reduce(parts) < 0, -1, key)


def seeds(items: Items, counts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, item, place) of the seeds, in key order."""
    p = np.log((counts + 0.5) / max(1, total + 1))
    keys, owner, place = [], [], []
    for k, words in enumerate(items.words):
        if len(words) < MIN_WORDS:
            continue
        key = grams(words, len(items.vocab))
        chance = sum(p[words[j:len(words) - SEED + 1 + j]] for j in range(SEED))
        half = np.sort(chance)[(len(chance) - 1) // 2]
        at = np.flatnonzero((chance <= np.log(RARE)) | (chance <= half))
        keys.append(key[at])
        owner.append(np.full(len(at), k))
        place.append(at)
    if not keys:
        return (np.empty(0, np.int64),) * 3
    key, owner, place = map(np.concatenate, (keys, owner, place))
    order = np.argsort(key, kind="stable")
    return key[order], owner[order], place[order]


STEP = np.uint64(0x9E3779B97F4A7C15)


def run_keys(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    places = words.astype(np.uint64)
    key = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n if len(key) else 0):
        key = (key ^ places[k:len(words) - n + 1 + k]) * STEP
        key ^= key >> np.uint64(29)
    return key


Runs = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def runs_of(items: Items, counts: np.ndarray, total: int) -> Runs:
    """By length: (key, item, place), in key order, of the runs that are leaks by themselves."""
    p = np.log((counts + 0.5) / max(1, total + 1))
    found: dict[int, list] = {}
    for k, words in enumerate(items.words):
        n = len(words) if len(words) < MIN_WORDS else RUN
        if len(words) >= n and (n == RUN or p[words].sum() <= np.log(RARE)):
            keys = run_keys(words, n)
            found.setdefault(n, []).append((keys, np.full(len(keys), k), np.arange(len(keys))))
    out = {}
    for n, parts in found.items():
        key, owner, place = map(np.concatenate, zip(*parts))
        order = np.argsort(key, kind="stable")
        out[n] = key[order], owner[order], place[order]
    return out


def run_hits(words: np.ndarray, before: np.ndarray, runs: Runs) -> dict[int, dict[int, np.ndarray]]:
    """By text and item: where the item would begin, for each run found."""
    out: dict[int, dict[int, np.ndarray]] = {}
    unknown = np.r_[0, np.cumsum(words < 0)]
    for n, (key, owner, place) in runs.items():
        if len(words) < n:
            continue
        spots = np.flatnonzero(unknown[n:] == unknown[:-n])
        text = np.searchsorted(before, spots, "right") - 1
        inside = spots + n <= before[text + 1]
        spots, text = spots[inside], text[inside]
        own = run_keys(words, n)[spots]
        low = np.searchsorted(key, own)
        hit = key[np.minimum(low, len(key) - 1)] == own
        spots, text, low, own = spots[hit], text[hit], low[hit], own[hit]
        hits = np.searchsorted(key, own, "right") - low
        which = np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(int(hits.sum()))
        text, begin, item = np.repeat(text, hits), np.repeat(spots, hits) - place[which], owner[which]
        for t in np.unique(text).tolist():
            here = text == t
            for k in np.unique(item[here]).tolist():
                out.setdefault(t, {})[k] = np.unique(begin[here & (item == k)]) - before[t]
    return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(best Smith-Waterman score, end of the alignment in ``passage``, exclusive)."""
    n = len(passage)
    steps = np.arange(n + 1)
    above, best, end = np.zeros(n + 1, dtype=np.int64), 0, 0
    for w in item.tolist():
        row = np.zeros(n + 1, dtype=np.int64)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + np.where(passage == w, 2, -1), above[1:] - 1))
        row = np.maximum.accumulate(row + steps) - steps  # gaps within the row
        if (top := int(row.max())) > best:
            best, end = top, int(row.argmax())
        above = row
    return best, end


def _align_span(item: np.ndarray, passage: np.ndarray, threshold: float) -> tuple[float, int, int] | None:
    known = np.bincount(item, minlength=int(item.max()) + 1)
    common = np.bincount(passage[(passage >= 0) & (passage < len(known))], minlength=len(known))
    if 2 * np.minimum(known, common).sum() < threshold * 2 * len(item):
        return None  # matches alone cannot reach the threshold
    best, end = align(item, passage)
    score = best / (2 * len(item))
    if score < threshold:
        return None
    _, back = align(item[::-1], passage[:end][::-1])
    return score, end - back, end


def _best(item: np.ndarray, words: np.ndarray, begin: np.ndarray, threshold: float) -> tuple[float, int, int] | None:
    """(score, start, end) of the best alignment around the places ``begin`` (ascending)."""
    m = len(item)
    slack = max(8, m // 2)
    cut = np.flatnonzero(np.diff(begin) > 2 * slack + m) + 1
    best = None
    for part in np.split(begin, cut):
        low, high = max(0, int(part[0]) - slack), min(len(words), int(part[-1]) + m + slack)
        found = _align_span(item, words[low:high], threshold)
        if found and (best is None or found[0] > best[0]):
            best = (found[0], low + found[1], low + found[2])
    return best


def _matcher(items: Items, key: np.ndarray, owner: np.ndarray, place: np.ndarray, threshold: float) -> Callable:
    """A function from a text's words (places, -1 unknown) to its results (item, score, start, end, seeds hit)."""

    def match(words: np.ndarray, spots: np.ndarray, lows: np.ndarray, highs: np.ndarray,
              runs: dict[int, np.ndarray]) -> list[tuple]:
        hits = highs - lows
        which = np.repeat(lows - (np.cumsum(hits) - hits), hits) + np.arange(int(hits.sum()))
        spot = np.repeat(spots, hits)
        out: dict = {}  # the best by item_id
        item_of = owner[which]
        for k in sorted({*np.unique(item_of).tolist(), *runs}):
            own = item_of == k
            word, begin = items.words[k], np.sort(spot[own] - place[which[own]])
            best = _best(word, words, begin, threshold) if len(begin) else None
            if best is None and k in runs:
                best = _best(word, words, runs[k], 0.0)
            if best and (items.ids[k] not in out or best[0] > out[items.ids[k]][1]):
                out[items.ids[k]] = (items.ids[k], *best, int(own.sum()))
        return list(out.values())

    return match


def _scan(column: pa.Array, items: Items, key: np.ndarray, owner: np.ndarray, place: np.ndarray, runs: Runs,
          threshold: float) -> Iterator[tuple[int, list[tuple]]]:
    """(row, results) of every text that has any."""
    match = _matcher(items, key, owner, place, threshold)
    data, offsets = utf8_of(column)
    for i, j in chunks(offsets):
        hashes, before = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        words = items.places(hashes)
        gram = grams(words, len(items.vocab))
        alone = run_hits(words, before, runs)
        low = np.searchsorted(key, gram)
        spots = np.flatnonzero((gram >= 0) & (key[np.minimum(low, len(key) - 1)] == gram)) if len(key) else \
            np.empty(0, np.int64)
        text = np.searchsorted(before, spots, "right") - 1
        inside = spots + SEED <= before[text + 1]  # no n-gram across texts
        spots, text = spots[inside], text[inside]
        high = np.searchsorted(key, gram[spots], "right")
        for t in sorted({*np.unique(text).tolist(), *alone}):
            own = text == t
            begin = before[t]
            found = match(words[begin:before[t + 1]], spots[own] - begin, low[spots[own]], high[own], alone.get(t, {}))
            if found:
                yield i + t, found


def blocks_of(benchmark: DataFrame, text: str = "text") -> Iterator[list]:
    """The distinct items in blocks of about BLOCK_WORDS words (by hash of the item, so no order is needed)."""
    items = benchmark.select("item_id", F.col(text).alias("text"))
    size = items.distinct().agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-size // BLOCK_WORDS))
    for b in range(n):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct().orderBy("item_id", "text").collect()


RESULT = ["doc_id", "item_id", "score", "start_word", "end_word", "n_seeds"]


def _best_of_blocks(found: list[DataFrame]) -> DataFrame:
    """The best row per document row and item_id of all blocks (RESULT and ``text_hash``).

    Document rows of equal doc_id and text have equal results in each block, so their number is that of any block."""
    if len(found) == 1:
        return found[0].select(*RESULT)
    rows = None
    for b, part in enumerate(found):
        part = part.withColumn("block", F.lit(b))
        rows = part if rows is None else rows.unionByName(part)
    first = F.max(F.struct("score", (-F.col("start_word")).alias("back"), "end_word", "n_seeds")).alias("best")
    each = rows.groupBy("doc_id", "text_hash", "item_id", "block").agg(first, F.count(F.lit(1)).alias("n"))
    best = each.groupBy("doc_id", "text_hash", "item_id").agg(F.max("best").alias("best"), F.max("n").alias("n"))
    return best.select("doc_id", "item_id", "best.score", (-F.col("best.back")).alias("start_word"), "best.end_word",
                       "best.n_seeds", F.explode(F.sequence(F.lit(1), "n"))).select(*RESULT)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word (of the passage, exclusive), n_seeds: one row per leak."""
    parts = []
    for rows in blocks_of(benchmark):
        items = item_block(rows)
        seen = word_counts(docs, items, text)
        found = *seeds(items, *seen), runs_of(items, *seen)

        def scan(batches: Iterator[pa.RecordBatch], items=items, found=found) -> Iterator[pa.RecordBatch]:
            for batch in lean(batches):
                ids, hashes = batch.column(0), batch.column(2)
                rows = [(ids[r].as_py(), *x, hashes[r].as_py()) for r, xs in _scan(batch.column(1), items, *found, threshold) for x in xs]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=[*RESULT, "text_hash"])

        parts.append(docs.select("doc_id", text, F.xxhash64(text)).mapInArrow(
            scan, "doc_id long, item_id long, score double, start_word long, end_word long, n_seeds long, text_hash long"))
    return _best_of_blocks(parts)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) without a leak; no shuffle."""
    at = docs.columns.index(text)
    for rows in blocks_of(benchmark):
        items = item_block(rows)
        seen = word_counts(docs, items, text)
        found = *seeds(items, *seen), runs_of(items, *seen)

        def keep(batches: Iterator[pa.RecordBatch], items=items, found=found) -> Iterator[pa.RecordBatch]:
            for batch in lean(batches):
                mask = np.ones(batch.num_rows, dtype=bool)
                mask[[r for r, _ in _scan(batch.column(at), items, *found, threshold)]] = False
                yield batch.filter(pa.array(mask))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op9_decontam(spark, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item into a document."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
