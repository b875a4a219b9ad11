"""URL filter: allow/block rules on host and path, and logistic regression on hashed character
n-grams of host and path for every URL that no rule decides.

The model is trained from a small labelled URL table (the package's ``labelled_urls.tsv`` unless the caller
gives its own list); that table is the documented bound of the training sample.  Scoring is a narrow
projection: the weights (one float per hash slot, 2**HASH_BITS of them) travel with the task.

Defined cases: a null URL, or one without ``://``, has empty host and path, fits no rule and is
judged by the model on empty strings; a null page_id stays null; very long URLs are scored whole; rules are judged per row, so ties and
repeated rows give equal verdicts; two fitting rules of the same length: block wins; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import chunks, lean, mix, ragged

HASH_BITS = 14
NGRAMS = (3, 4, 5)
ODD = np.uint64(0x9E3779B97F4A7C15)
#: What a path's n-grams count beside the host's.
PATH_WEIGHT = 0.5
#: Characters of URLs that are hashed at once (a longer URL is hashed alone).
CHARS = 1 << 19
#: A URL is blocked from this probability on.
THRESHOLD = 0.5


@dataclass(frozen=True)
class UrlRule:
    """``rule`` is host + path prefix (``example.org/es/``); it fits the host and all its subdomains."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host):]


#: Fixed values of the contract.
RULES: tuple[UrlRule, ...] = (
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
)

#: The small labelled URL table, a line of label (1: block), tab, URL each: made-up hosts, none from a given table.
LABELLED = "labelled_urls.tsv"


def labelled_urls() -> list[tuple[str, int]]:
    """The rows of ``LABELLED``; read as package data, so it is found in a zipped package, too."""
    rows = (line.split("\t") for line in pkgutil.get_data(__package__, LABELLED).decode().splitlines())
    return [(url, int(label)) for label, url in rows]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[UrlRule] = RULES) -> Column:
    """(rule, verdict) of the longest fitting rule, else null."""
    order = sorted(rules, key=lambda r: (-len(r.rule), r.verdict != "block"))
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in order]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def slots(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(URL, slot, value) of the distinct n-grams of every URL by hash slot, by URL; the host's lie in the lower half of the
    slots, the path's in the upper.  The squares of a host's values add up to 1, those of a path's to PATH_WEIGHT squared.

    An n-gram's slot is that of the sum over its characters of their code points times odd powers, mixed; all digits
    count as 0, since page numbers say nothing."""
    found, half = [], HASH_BITS - 1
    for part, texts in enumerate((hosts, paths)):
        framed = [f"^{t}$" for t in texts]
        length = np.fromiter(map(len, framed), np.int64, len(framed))
        code = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        code = np.where((code >= 48) & (code <= 57), np.uint64(48), code)
        url, left = np.repeat(np.arange(len(framed)), length), ragged(np.zeros(len(framed), np.int64), length)
        left = length[url] - left  # characters from here to the text's end
        for n in NGRAMS:
            at = np.flatnonzero(left >= n)
            h = np.full(len(at), n, dtype=np.uint64)
            for k in range(n):
                h = h * ODD + code[at + k]
            found.append((url[at] << HASH_BITS) | (part << half) | (mix(h) & np.uint64((1 << half) - 1)).astype(np.int64))
    both = np.unique(np.concatenate(found))
    owner = both >> half  # URL and part
    value = 1 / np.sqrt(np.bincount(owner, minlength=1))[owner]
    return both >> HASH_BITS, both & ((1 << HASH_BITS) - 1), np.where(owner & 1, PATH_WEIGHT * value, value)


def split_url(url: str | None) -> tuple[str, str]:
    """Python twin of ``host_of`` and ``path_of`` for the few labelled URLs."""
    rest = (url or "").partition("://")[2]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    host = rest[:end].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return host, tail[:stop]


def margins(url: np.ndarray, slot: np.ndarray, value: np.ndarray, n: int, w: np.ndarray, b: float) -> np.ndarray:
    """The model's log-odds of n URLs."""
    return np.bincount(url, weights=w[slot] * value, minlength=n) + b


def train(labelled: Sequence[tuple[str, int]] | None = None, epochs: int = 300, rate: float = 0.5,
          l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch gradient descent; both labels weigh the same in all, however many rows they have."""
    labelled = labelled_urls() if labelled is None else labelled
    parts = [split_url(u) for u, _ in labelled]
    url, slot, value = slots([h for h, _ in parts], [p for _, p in parts])
    y = np.array([float(label) for _, label in labelled])
    share = np.where(y == 1, y.mean(), 1 - y.mean())
    w, b = np.zeros(1 << HASH_BITS), 0.0
    for _ in range(epochs):
        g = (1 / (1 + np.exp(-margins(url, slot, value, len(parts), w, b))) - y) / (2 * share)
        w -= rate * (np.bincount(slot, weights=g[url] * value, minlength=len(w)) + l2 * w)
        b -= rate * g.mean()
    return w, b


def block_probabilities(hosts: Sequence[str], paths: Sequence[str], w: np.ndarray, b: float) -> np.ndarray:
    """The model's block probability of every URL, some CHARS characters at a time."""
    ends = np.cumsum([len(h) + len(p) + 4 for h, p in zip(hosts, paths)])
    out = [np.empty(0)]
    for i, j in chunks(np.r_[0, ends].astype(np.int64), CHARS):
        out.append(1 / (1 + np.exp(-margins(*slots(hosts[i:j], paths[i:j]), j - i, w, b))))
    return np.concatenate(out)


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES,
               labelled: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's block probability, null where a rule decides)."""
    w, b = train(labelled)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = (parts.withColumn("r", longest_rule(F.col("host"), F.col("path"), rules))
             .select("page_id", "host", "path", "r.rule", "r.verdict"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            hosts, paths, verdicts = (batch.column(c).to_pylist() for c in ("host", "path", "verdict"))
            open_rows = [i for i, v in enumerate(verdicts) if v is None]
            p: list[float | None] = [None] * len(verdicts)
            for i, x in zip(open_rows, block_probabilities([hosts[i] for i in open_rows], [paths[i] for i in open_rows], w, b)):
                p[i] = float(x)
            said = [v if v is not None else ("block" if x >= THRESHOLD else "allow") for v, x in zip(verdicts, p)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3),
                 pa.array(said, pa.string()), pa.array(p, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "score"])

    return ruled.mapInArrow(score, "page_id long, host string, path string, rule string, verdict string, score double")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, deciding rule and verdict."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
