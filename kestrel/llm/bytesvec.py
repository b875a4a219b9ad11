"""Vector helpers over the UTF-8 bytes of Arrow string columns: no Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time (a longer single text is handled alone).
CHUNK = 1 << 20
#: The contracts' white space, as a table over bytes.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; memory that Arrow and the C heap hold for those before is given back to the system.

    Python workers live on between tasks, so what they keep unused adds to the executor's memory for good."""
    heap = ctypes.CDLL(None)
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if hasattr(heap, "malloc_trim"):
            heap.malloc_trim(0)


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SegmentHasher:
    """64-bit hashes of byte segments: the sum over bytes of a random value per byte times a random odd value
    per position, mixed with the length.  ``blank`` bytes count for nothing, so a segment may trail white space."""

    def __init__(self, seed: int, blank: np.ndarray | None = None):
        self.seed = seed
        self.by_byte = np.random.default_rng((seed, 0)).integers(1, 1 << 63, size=256, dtype=np.uint64)
        if blank is not None:
            self.by_byte[blank] = 0
        self.by_place = np.empty(0, np.uint64)

    def _places(self, n: int) -> np.ndarray:
        while len(self.by_place) < n:
            block = np.random.default_rng((self.seed, 1 + len(self.by_place) // 1024))
            more = block.integers(0, 1 << 63, size=1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            self.by_place = np.concatenate([self.by_place, more])
        return self.by_place

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Hashes of the segments that begin at ``starts`` and run to the next one (the last to the end);
        ``starts`` begins at 0 and increases, ``lengths`` are the lengths without blanks."""
        if not len(starts):
            return np.empty(0, np.uint64)
        spans = np.diff(np.r_[starts, len(data)])
        place = np.arange(len(data), dtype=np.int64) - np.repeat(starts, spans)
        value = self.by_byte[data] * self._places(int(spans.max()))[place]
        return mix(np.add.reduceat(value, starts) ^ mix(lengths.astype(np.uint64)))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each of the given runs, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def word_segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, rows) of the words in the texts at ``offsets`` (offsets[0] == 0): runs of non-space bytes."""
    solid = ~IS_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = solid[heads]  # a word never goes on into the next text
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = solid[tails]
    ends = np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends - starts, rows
