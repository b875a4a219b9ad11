"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

Features of a line are binned shares of its characters and words (capitals, symbols, bars, digits,
immediate word repeats, ...) and the same bins of the lines before and after it.  Forward-backward
gives every line's probability of being bad; their mean, weighted by line length, is the document's
bad share, and a logistic curve fitted on the training documents turns it into the score.

Training: labels mark documents, so the lines of a good document are good, and the lines of a bad
one start out bad and are relabelled by the model in ``ROUNDS`` rounds (its worst line stays bad).
The sample is bounded: the ``TRAIN_DOCS`` labelled documents with the smallest hash of their doc_id,
of a longer one ``TRAIN_LINES`` lines in ``TRAIN_RUNS`` runs from its first to its last; only bins leave the executors.  Rows whose crc32(doc_id as
text) mod 5 is 0 are held out.  Scoring is a narrow projection over whole texts.

Defined cases: null, empty and blank texts count as one line of length zero; repeated rows are scored
one by one; a null doc_id is never held out and never used for training, nor are null labels; a
sample without one of the two labels gives the score 1 - (share of bad labels) to every text, 1 if
there is no label at all; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import IS_SPACE, SegmentHasher, chunks, lean, utf8_of, word_segments
from kestrel.llm.common import bounded_batches

FOLDS = 5
TRAIN_DOCS = 4000
TRAIN_LINES = 200
#: A text of more lines trains with so many runs of its lines.
TRAIN_RUNS = 4
ROUNDS = 3
STEPS = 150
#: A document is predicted good from this score on.
THRESHOLD = 0.3


def _table(members: str) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(members.encode(), dtype=np.uint8))


#: Byte classes whose share of a line's characters is a feature.
CLASSES: tuple[np.ndarray, ...] = (
    (np.arange(256) >= 65) & (np.arange(256) <= 90) | (np.arange(256) == 0xC3),  # capitals (0xC3 is weighed below)
    (np.arange(256) >= 48) & (np.arange(256) <= 57),
    _table("#*$%&<>~^_=+@\\{}[]"),
    _table("|"),
    _table("!?"),
    _table(".,;:"),
    np.arange(256) >= 0x80,
)
#: Bin edges: shares per character, share of immediate word repeats, words, characters per word.
SHARE_BINS = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4])
REPEAT_BINS = np.array([0.0, 0.05, 0.15, 0.3, 0.5])
WORD_BINS = np.array([0.5, 3.5, 8.5, 20.5, 60.5])
LENGTH_BINS = np.array([1.0, 3.0, 4.5, 6.0, 8.0, 12.0])
SIZES = [len(SHARE_BINS) + 1] * len(CLASSES) + [len(REPEAT_BINS) + 1, len(WORD_BINS) + 1, len(LENGTH_BINS) + 1, 2]
OFFSETS = np.r_[0, np.cumsum(SIZES)]
N_BINS = int(OFFSETS[-1])
N_FEATURES = len(SIZES)
#: Bin of a neighbour that does not exist, one each side.
WIDTH = 3 * N_BINS + 2
HASHER = SegmentHasher(8, IS_SPACE)


def line_bins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins per line, length per line, lines per text): lines without a word are left out; a text without any
    counts as one line of length zero."""
    n = len(offsets) - 1
    starts, lengths, rows = word_segments(data, offsets)
    if not len(starts):
        empty = np.array([[OFFSETS[k] for k in range(N_FEATURES)]] * n, dtype=np.int32).reshape(n, N_FEATURES)
        return empty, np.zeros(n), np.ones(n, dtype=np.int64)
    # a line begins with the first word of a text or after a newline
    breaks = np.flatnonzero(data == 10)
    seen = np.searchsorted(breaks, starts)
    fresh = np.r_[True, (rows[1:] != rows[:-1]) | (seen[1:] != seen[:-1])]
    head = np.flatnonzero(fresh)  # first word of each line
    line_row = rows[head]
    begin = starts[head]
    last = np.r_[head[1:], len(starts)] - 1
    end = starts[last] + lengths[last]
    chars = (end - begin).astype(float)
    bounds = np.stack([begin, end], axis=1).ravel()
    closed = bounds[-1] == len(data)
    bounds = bounds[:-1] if closed else bounds
    shares = [np.add.reduceat(c[data].astype(np.int32), bounds)[::2] for c in CLASSES]
    # a capital beyond ASCII is 0xC3 0x80-0x9E: undo the lead bytes of small letters
    small = np.zeros(len(data), dtype=np.int32)
    small[:-1] = (data[:-1] == 0xC3) & ((data[1:] < 0x80) | (data[1:] > 0x9E))
    shares[0] = shares[0] - np.add.reduceat(small, bounds)[::2]
    n_words = np.diff(np.r_[head, len(starts)])
    spans = np.diff(np.r_[starts, len(data)])
    hashes = HASHER(data[starts[0]:], starts - starts[0], lengths) if len(spans) else np.empty(0, np.uint64)
    again = np.r_[False, hashes[1:] == hashes[:-1]] & ~fresh
    repeats = np.add.reduceat(again.astype(np.int32), head) / n_words
    letters = np.add.reduceat(lengths, head) / n_words
    columns = [np.searchsorted(SHARE_BINS, s / chars) for s in shares]
    columns += [np.searchsorted(REPEAT_BINS, repeats), np.searchsorted(WORD_BINS, n_words),
                np.searchsorted(LENGTH_BINS, letters), np.isin(data[end - 1], [33, 46, 63]).astype(np.int64)]
    bins = (np.stack(columns, axis=1) + OFFSETS[:-1]).astype(np.int32)
    per_text = np.bincount(line_row, minlength=n)
    if (per_text == 0).any():  # blank texts
        blank = np.flatnonzero(per_text == 0)
        bins = np.concatenate([bins, np.tile(OFFSETS[:-1].astype(np.int32), (len(blank), 1))])
        chars, line_row = np.r_[chars, np.zeros(len(blank))], np.r_[line_row, blank]
        order = np.argsort(line_row, kind="stable")
        bins, chars, per_text = bins[order], chars[order], np.maximum(per_text, 1)
    return bins, chars, per_text


def with_neighbours(bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of each line: its bins, those of the line before and of the line after in the same text."""
    n, first = len(bins), np.zeros(len(bins), dtype=bool)
    first[np.cumsum(counts) - counts] = True
    last = np.r_[first[1:], True]
    before, after = np.full_like(bins, 3 * N_BINS), np.full_like(bins, 3 * N_BINS + 1)
    before[1:] = bins[:-1] + N_BINS
    after[:-1] = bins[1:] + 2 * N_BINS
    before[first], after[last] = 3 * N_BINS, 3 * N_BINS + 1
    return np.concatenate([bins, before, after], axis=1) if n else np.empty((0, 3 * N_FEATURES), np.int32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # log-odds of bad per feature
    start: np.ndarray  # log-potential of the first label (good, bad)
    moves: np.ndarray  # log-potentials of label pairs
    slope: float = -8.0
    offset: float = 4.0


def forward_backward(emit: np.ndarray, counts: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(bad) per line, summed pair marginals, log-likelihood normaliser), all chains of a batch side by side."""
    n = len(emit)
    firsts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    f, c = firsts[order], counts[order]
    longest = int(c[0]) if len(c) else 0
    alive = [int(np.searchsorted(-c, -t, "left")) for t in range(longest)]  # chains with more than t lines
    potential = np.exp(np.clip(np.stack([np.zeros(n), emit], axis=1), -30, 30))
    move = np.exp(model.moves)
    alpha, scale, beta = np.zeros((n, 2)), np.ones(n), np.ones((n, 2))
    for t in range(longest):
        at = f[:alive[t]] + t
        a = potential[at] * (np.exp(model.start) if t == 0 else alpha[at - 1] @ move)
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at][:, None]
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        k = alive[t + 1]
        at = f[:k] + t
        nxt = potential[at + 1] * beta[at + 1] / scale[at + 1][:, None]
        beta[at] = nxt @ move.T
        pairs += (alpha[at][:, :, None] * move * nxt[:, None, :]).sum(axis=0)
    gamma = alpha * beta
    return gamma[:, 1] / gamma.sum(axis=1), pairs, float(np.log(scale).sum())


def _fit_crf(x: np.ndarray, counts: np.ndarray, bad: np.ndarray, model: Model, l2: float = 1e-2,
             rate: float = 0.1) -> Model:
    """Conditional likelihood of the line labels, by Adam."""
    firsts = np.cumsum(counts) - counts
    inner = np.ones(len(x), dtype=bool)
    inner[firsts] = False
    inner = np.flatnonzero(inner)
    seen_pairs = np.bincount(2 * bad[inner - 1] + bad[inner], minlength=4).reshape(2, 2).astype(float)
    seen_start = np.bincount(bad[firsts], minlength=2).astype(float)
    theta = np.r_[model.weights, model.start, model.moves.ravel()]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, now = theta[:WIDTH], Model(theta[:WIDTH], theta[WIDTH:WIDTH + 2], theta[WIDTH + 2:].reshape(2, 2))
        p, pairs, _ = forward_backward(w[x].sum(axis=1), counts, now)
        diff = p - bad
        grad = np.r_[np.bincount(x.ravel(), weights=np.repeat(diff, x.shape[1]), minlength=WIDTH),
                     np.array([(1 - p[firsts]).sum(), p[firsts].sum()]) - seen_start, (pairs - seen_pairs).ravel()]
        grad = grad / len(counts) + l2 * theta / 10
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(theta[:WIDTH], theta[WIDTH:WIDTH + 2], theta[WIDTH + 2:].reshape(2, 2))


def bad_share(bins: np.ndarray, chars: np.ndarray, counts: np.ndarray, model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' P(bad) per text."""
    p, _, _ = forward_backward(model.weights[with_neighbours(bins, counts)].sum(axis=1), counts, model)
    firsts = np.cumsum(counts) - counts
    weight = np.maximum(chars, 1e-9)
    return np.add.reduceat(p * weight, firsts) / np.add.reduceat(weight, firsts)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(bins: np.ndarray, chars: np.ndarray, counts: np.ndarray, good: np.ndarray) -> Model:
    """Train on texts with document labels ``good`` (1 or 0)."""
    zero = Model(np.zeros(WIDTH), np.zeros(2), np.zeros((2, 2)))
    if not len(good) or good.min() == good.max():
        share = float(1 - good.mean()) if len(good) else 0.0
        return Model(zero.weights, zero.start, zero.moves, 0.0, 40.0 if share == 0 else -40.0)
    x, owner = with_neighbours(bins, counts), np.repeat(np.arange(len(counts)), counts)
    firsts = np.cumsum(counts) - counts
    bad = (good[owner] == 0).astype(np.int64)
    model = zero
    for _ in range(ROUNDS):
        model = _fit_crf(x, counts, bad, zero)
        p, _, _ = forward_backward(model.weights[x].sum(axis=1), counts, model)
        worst = np.maximum.reduceat(p, firsts)[owner]
        bad = ((good[owner] == 0) & ((p > 0.5) | (p == worst))).astype(np.int64)
    share = bad_share(bins, chars, counts, model)
    a, b = -8.0, 4.0  # score = logistic(a * share + b)
    weight = np.where(good == 1, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
    for _ in range(400):
        p = logistic(a * share + b)
        g = weight * (p - good)
        h = weight * p * (1 - p) + 1e-6
        hess = np.array([[(h * share * share).mean() + 1e-3, (h * share).mean()], [(h * share).mean(), h.mean() + 1e-3]])
        step = np.linalg.solve(hess, np.array([(g * share).mean() + 1e-3 * (a + 8) / 8, g.mean()]))
        a, b = a - 0.5 * step[0], b - 0.5 * step[1]
    return Model(model.weights, model.start, model.moves, float(a), float(b))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, good, text of the bounded sample of labelled rows that are not held out."""
    marked = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("good")))
    # the sample is chosen on doc_ids alone: the few chosen ids meet the texts afterwards
    chosen = (docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct().join(marked, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS))
    return docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")


def training_lines(n: int) -> np.ndarray:
    """Lines of a text of ``n`` lines that train: all, or TRAIN_LINES in runs spread evenly from its first line to its last."""
    if n <= TRAIN_LINES:
        return np.arange(n)
    size = TRAIN_LINES // TRAIN_RUNS
    starts = np.arange(TRAIN_RUNS) * (n - size) // (TRAIN_RUNS - 1)
    return (starts[:, None] + np.arange(size)).ravel()


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """The model of a bounded sample; executors compute the bins, the driver gets at most TRAIN_DOCS * TRAIN_LINES lines.

    Of rows with one doc_id a single one trains: the one whose line features come first."""
    bounded_batches(docs.sparkSession)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = utf8_of(batch.column(2))
            for i, j in chunks(offsets):
                bins, chars, counts = line_bins(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                ends = np.cumsum(counts)
                rows = [(d, g, bins[at].astype(np.int16).tobytes(), chars[at].tobytes())
                        for d, g, at in zip(batch.column(0).slice(i, j - i).to_pylist(),
                                            batch.column(1).slice(i, j - i).to_pylist(),
                                            (e - c + training_lines(c) for c, e in zip(counts.tolist(), ends.tolist())))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["doc_id", "good", "bins", "chars"])

    # one row per document, whatever repeats: the sample has TRAIN_DOCS rows at most
    sample = (training_sample(docs, labels, text).select("doc_id", "good", "text")
              .mapInArrow(binned, "doc_id long, good int, bins binary, chars binary")
              .groupBy("doc_id").agg(F.min(F.struct("good", "bins", "chars")).alias("own")).select("doc_id", "own.*")
              .orderBy("doc_id").collect())
    bins = [np.frombuffer(r["bins"], dtype=np.int16).reshape(-1, N_FEATURES) for r in sample]
    return fit(np.concatenate(bins).astype(np.int32) if bins else np.empty((0, N_FEATURES), np.int32),
               np.concatenate([np.frombuffer(r["chars"]) for r in sample]) if bins else np.empty(0),
               np.array([len(b) for b in bins], dtype=np.int64), np.array([r["good"] for r in sample], dtype=float))


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """Scores of an Arrow string column."""
    data, offsets = utf8_of(column)
    out = [np.empty(0)]
    for i, j in chunks(offsets):
        bins, chars, counts = line_bins(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        out.append(logistic(model.slope * bad_share(bins, chars, counts, model) + model.offset))
    return np.concatenate(out)


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    bounded_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_column(batch.column(1), model))],
                                             names=["doc_id", "score"])

    return (docs.select("doc_id", text).mapInArrow(score, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that the model does not reject; no shuffle."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            yield batch.filter(pa.array(score_column(batch.column(at), model) >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)


def op8_line_crf(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
