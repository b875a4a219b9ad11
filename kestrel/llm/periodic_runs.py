"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that is at least ``min_exponent`` periods and
``min_length`` words long and that no neighbouring word extends keeping period q.

Per stretch of whole texts, all as array operations:

1. Suffix array of the words by prefix doubling.  Names of equal words differ between texts, so neither a group of
   suffixes nor an LCP interval ever spans two texts.  The names after each round are kept.
2. LCP values of neighbouring suffixes from those names, and their LCP intervals [left, right) from the nearest
   smaller values, found by binary lifting over range minima; there are no tree nodes.
3. Branching tandem test: in an LCP interval of depth d, for each suffix i of every child but its largest, the
   inverse suffix array says whether i + d (or i - d) lies in the interval too, outside the child.  If so, a square
   of period d starts at i (or i - d) and the word behind it breaks the period: it is the rightmost square of a run.
   Every text position is in such a child for at most log2(n) intervals.
4. The square is rotated to the left as far as its period goes (binary lifting over the names), which gives the
   run's start.  Squares with the same start and end are one run, whose period is the smallest of them.

Words are named by 64-bit hashes; the runs found are compared word by word with the text, and a text where that
fails (two words with one hash) is done again with exact names.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; repeated rows and
rows with equal or null doc_ids are judged each for itself; other columns are ignored; an empty table gives an
empty result.  A text is handled whole in one task, however long: its memory is some 300 bytes per word at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import IS_SPACE, SegmentHasher, chunks, lean, mix, ragged, utf8_of, word_segments
from kestrel.llm.common import bounded_batches

MIN_EXPONENT = 4
MIN_LENGTH = 6
HASHER = SegmentHasher(12, IS_SPACE)
#: Suffixes that are tested at a time.
TESTED = 1 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"


def suffix_array(names: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, names by round): ``names`` are the words', ``end`` the end of each word's text.

    Round k names the 2**k words from each place on by the first slot of their group; a stretch that the end of
    its text cuts short has a name of its own."""
    n = len(names)
    order = np.argsort(names)
    fresh = np.r_[True, names[order][1:] != names[order][:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    slots = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
    levels, step = [rank], 1
    while len(slots):
        at = order[slots]
        ahead = at + step
        second = np.where(ahead < end[at], rank[np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
        keys = rank[at].astype(np.int64) * (n + 1) + second
        by = np.argsort(keys)
        at, keys = at[by], keys[by]
        order[slots] = at
        fresh = np.r_[True, keys[1:] != keys[:-1]]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        slots = slots[~(fresh & np.r_[fresh[1:], True])]
        levels.append(rank)
        step *= 2
    return order, levels


def lcp_values(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes of slots j - 1 and j have in common, for each slot j."""
    n = len(order)
    lcp = np.zeros(n, np.int32)
    first = levels[0]
    slots = 1 + np.flatnonzero(first[order[1:]] == first[order[:-1]])
    a, b = order[slots - 1].copy(), order[slots].copy()
    found = np.zeros(len(slots), np.int32)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        a[same] += 1 << k
        b[same] += 1 << k
        found[same] += 1 << k
    lcp[slots] = found
    return lcp


def _reach(lcp: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[left, right): the slots of the LCP interval that each boundary of ``slots`` belongs to."""
    n = len(lcp)
    solid = np.flatnonzero(np.diff(np.r_[0, (lcp > 0).view(np.int8), 0]))
    longest = int((solid[1::2] - solid[::2]).max(initial=1))
    least = [lcp]  # least[k][i]: minimum of the 2**k values from i on
    while 2 << (len(least) - 1) <= longest:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    depth = lcp[slots]
    left, right = slots.copy(), slots + 1
    for k in range(len(least) - 1, -1, -1):
        size, low = 1 << k, least[k]
        at = np.maximum(left - size, 0)
        left = np.where((left >= size) & (low[at] >= depth), at, left)
        at = np.minimum(right, len(low) - 1)
        right = np.where((right + size <= n) & (low[at] >= depth), right + size, right)
    return left - 1, right


def branching_squares(order: np.ndarray, levels: list[np.ndarray], lcp: np.ndarray,
                      copies: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the squares that the word behind them, or the end of the text, breaks.

    LCP intervals of fewer than ``copies`` suffixes cannot hold as many repeats and are left out."""
    n, place_of = len(order), levels[-1]
    slots = np.flatnonzero(lcp > 0)
    if not len(slots):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = _reach(lcp, slots)
    wide = right - left >= copies
    slots, left, right = slots[wide], left[wide], right[wide]
    by = np.lexsort((slots, right, left))
    slots, left, right = slots[by], left[by], right[by]
    first = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])][:len(slots)]
    last = np.r_[first[1:], True][:len(slots)]
    interval = np.cumsum(first) - 1
    # the children of an interval lie between its left end, its boundaries and its right end
    begin = np.r_[np.where(first, left, np.r_[0, slots[:-1]]), slots[last]]
    until = np.r_[slots, right[last]]
    child_of = np.r_[interval, interval[last]]
    by = np.lexsort((begin - until, child_of))
    largest = np.r_[True, child_of[by][1:] != child_of[by][:-1]][:len(by)]
    small = by[~largest]
    heads = np.flatnonzero(first)
    sizes = until[small] - begin[small]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()) + TESTED, TESTED))
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in zip(cuts, [*cuts[1:], len(small)]):
        own = small[i:j]
        count = until[own] - begin[own]
        at = order[ragged(begin[own], count)]
        each = np.repeat(own, count)
        top = heads[child_of[each]]
        depth = lcp[slots[top]].astype(np.int64)
        for square, other in ((at, at + depth), (at - depth, at - depth)):
            inside = np.flatnonzero((other >= 0) & (other < n))
            slot = place_of[other[inside]]
            c, t = each[inside], top[inside]
            hit = (slot >= left[t]) & (slot < right[t]) & ((slot < begin[c]) | (slot >= until[c]))
            places.append(square[inside[hit]])
            periods.append(depth[inside[hit]])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(names: np.ndarray, first: np.ndarray, end: np.ndarray, min_exponent: int = MIN_EXPONENT,
            min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of the runs, by start and period; ``first`` and ``end`` bound each word's text."""
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    nothing = (np.empty(0, np.int64),) * 3
    if not len(names):
        return nothing
    order, levels = suffix_array(names, end)
    if len(levels) == 1:
        return nothing
    at, period = branching_squares(order, levels, lcp_values(order, levels), min_exponent)
    stop, start, low = at + 2 * period, at.copy(), first[at]
    for k in range(len(levels) - 1, -1, -1):  # rotate to the left
        back = start - (1 << k)
        can = np.flatnonzero(back >= low)
        same = can[levels[k][back[can]] == levels[k][back[can] + period[can]]]
        start[same] = back[same]
    long = (stop - start >= min_exponent * period) & (stop - start >= min_length)
    start, stop, period = start[long], stop[long], period[long]
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    new = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])][:len(by)]
    start, stop, period = start[new], stop[new], period[new]
    by = np.lexsort((period, start))
    return start[by], stop[by], period[by]


def _holds(words: list[bytes], start: int, stop: int, period: int) -> bool:
    return (words[start:stop - period] == words[start + period:stop]
            and (start == 0 or words[start - 1] != words[start - 1 + period])
            and (stop == len(words) or words[stop] != words[stop - period]))


def _exact(words: list[bytes], min_exponent: int, min_length: int) -> list[tuple[int, int, int]]:
    ids: dict[bytes, int] = {}
    names = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    whole = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    return list(zip(*(x.tolist() for x in runs_of(names, *whole, min_exponent, min_length))))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those behind the first period of a run that holds them."""
    kept, at = [], 0
    for begin, stop in sorted((s + p, e) for s, e, p in runs):
        kept += words[at:begin]
        at = max(at, stop)
    return b" ".join(kept + words[at:])


def _search(data: np.ndarray, offsets: np.ndarray, min_exponent: int, min_length: int):
    """(n_words, runs, collapsed text) of each text."""
    begins, lengths, row = word_segments(data, offsets)
    names = HASHER(data[begins[0]:], begins - begins[0], lengths) if len(begins) else np.empty(0, np.uint64)
    names = mix(names + np.uint64(0x9E3779B97F4A7C15) * (row.astype(np.uint64) + np.uint64(1)))
    counts = np.bincount(row, minlength=len(offsets) - 1)
    after = np.cumsum(counts)
    first, end = (after - counts)[row], after[row]
    start, stop, period = runs_of(names, first, end, min_exponent, min_length)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for s, e, p, r, b in zip(*(x.tolist() for x in (start, stop, period, row[start], first[start]))):
        found.setdefault(r, []).append((s - b, e - b, p))
    raw = data.tobytes()
    for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        words, runs = raw[a:b].split(), found.get(r, [])
        if not all(_holds(words, *x) for x in runs):
            runs = _exact(words, min_exponent, min_length)
        yield len(words), runs, _collapsed(words, runs)


def periodic_runs(docs: DataFrame, text: str = "text", *, min_exponent: int = MIN_EXPONENT,
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period), collapsed: one row per row of ``docs``.

    ``collapsed`` is the text, its words joined by one space, without the words of each run behind its first period."""
    bounded_batches(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = utf8_of(batch.column(1))
            for i, j in chunks(offsets):
                got = list(_search(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], min_exponent, min_length))
                flat = np.array([x for _, runs, _ in got for x in runs], dtype=np.int64).reshape(-1, 3)
                runs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]),
                                                   pa.array(flat[:, 2])], names=["start", "length", "period"])
                at = np.r_[0, np.cumsum([len(runs) for _, runs, _ in got])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([n for n, _, _ in got], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at), runs),
                     pa.array([t for _, _, t in got], pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("t")).mapInArrow(
        search, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's periodic rewriting: of the texts whose crc32 of the doc_id ends in 0, the
    words from place a on repeat p words.  A null doc_id has no crc32; its text stays."""
    bounded_batches(docs.sparkSession)

    def rewritten(doc_id: int | None, text: str | None) -> str | None:
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 or not (words := (text or "").encode().split()):
            return text
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        cycle = words[a:a + p]
        return b" ".join(words[:a] + (cycle * -(-(n - a) // p))[:n - a]).decode()

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            ids, texts = batch.column(0), batch.column(1)
            new = [rewritten(i, t) for i, t in zip(ids.to_pylist(), texts.to_pylist())]
            yield pa.RecordBatch.from_arrays([ids, pa.array(new, texts.type)], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(rewrite, "doc_id long, text string")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of every document, the greatest one, and the text with its runs collapsed."""
    found = periodic_runs(with_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("(1000 * best.length) div -best.p").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words")
