"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits, a majority vote over the XXH64 of word shingles.  Two fingerprints link at
``RADIUS`` or fewer differing bits; the result is the connected components of those links.

Covering masks: every bit i gets a vector phi(i) of RADIUS + 1 bits, and every non-zero vector v of
that length gives one table whose key keeps the bits with <phi(i), v> = 1.  RADIUS differing bits span
at most RADIUS dimensions, so some v is orthogonal to all of them and both fingerprints meet in its
table: no pair is lost.  Tables hold distinct fingerprints only, so exact copies cost nothing.

A bucket of more than ``BUCKET`` fingerprints is dealt again by a second, third and fourth set of
masks, each of which covers the radius as well; what is left after four levels differs in a handful
of bits, so a bucket there is bounded by their combinations.  Within a bucket only a spanning forest
of the links is emitted (one row per newly reached fingerprint), never all pairs.

Defined cases: null, empty and blank texts have fingerprint 0 and link like any other; repeated rows
stay rows and share their component; a null doc_id does not count as smallest (a component of such
rows only has component_id null); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from kestrel.llm.bytesvec import lean
from kestrel.llm.common import bounded_batches, fresh_name
from kestrel.llm.components import connected_components
from kestrel.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Buckets beyond this many fingerprints are dealt again by the next level's masks.
BUCKET = 64
LEVELS = 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, ASCII spaces split
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_digest(joined, SEED)]
    else:
        ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
        starts = [0, *(e + 1 for e in ends)]
        digest = xxhash.xxh64_digest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:])]
    votes = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.frombuffer(b"".join(hashes[i:i + 65_536]), dtype=np.uint8).reshape(-1, BITS // 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, column: str, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as ``column`` (bigint)."""
    at = docs.columns.index(text)
    bounded_batches(docs.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            found = pa.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, column])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def masks(level: int, radius: int = RADIUS) -> list[int]:
    """The covering masks of a level: 2**(radius + 1) - 1 of them, BITS / 2 bits each."""
    size = 1 << (radius + 1)
    phi = np.random.default_rng(level).permutation(BITS) % size
    return [sum(1 << i for i in range(BITS) if int(phi[i] & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dealt(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """(key, fp): a row per table; the key hashes what came before, the table and the kept bits (equal keys
    of unequal buckets only add candidates: links are verified)."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).cast("long").alias("m"))
                       for t, m in enumerate(masks(level, radius))])
    return (rows.select("key", "fp", F.explode(tables).alias("s"))
            .select(F.xxhash64("key", "s.t", F.col("fp").bitwiseAND(F.col("s.m"))).alias("key"), "fp"))


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints: breadth first, one vector operation per node."""
    out, open_ = [], np.ones(len(fps), dtype=bool)
    for root in range(len(fps)):
        if not open_[root]:
            continue
        open_[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(open_)
            near = rest[np.bitwise_count(fps[rest] ^ fps[at]) <= radius]
            open_[near] = False
            out += [(at, int(j)) for j in near]
            queue += near.tolist()
    return out


def _links(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b): a spanning forest of each bucket's links; ``rows`` (key, fp) come sorted by key in each partition."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            sizes = np.diff(cut)
            two = cut[:-1][sizes == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
            a, b = [fps[two]], [fps[two + 1]]
            for start, size in zip(cut[:-1][sizes > 2], sizes[sizes > 2]):
                own = fps[start:start + size]
                if pairs := _forest(own, radius):
                    x = np.array(pairs)
                    a.append(own[x[:, 0]])
                    b.append(own[x[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a).view(np.int64)),
                                               pa.array(np.concatenate(b).view(np.int64))], names=["a", "b"])

        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in lean(batches):
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last bucket may go on
            if last:
                yield found(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield found(keys, fps)

    return rows.select("key", "fp").sortWithinPartitions("key").mapInArrow(edges, "a long, b long")


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, levels: int = LEVELS) -> DataFrame:
    """(a, b): links among the distinct fingerprints ``fps`` (fp) that connect all that are connected."""
    rows, out = fps.select(F.lit(0).cast("long").alias("key"), "fp"), None
    for level in range(1, levels + 1):
        size = F.count(F.lit(1)).over(W.partitionBy("key"))
        counted = materialize(_dealt(rows, level, radius).withColumn("n", size).filter("n > 1"), f"buckets{level}")
        here = counted if level == levels else counted.filter(F.col("n") <= bucket)
        found = _links(here.repartition("key"), radius)
        out = found if out is None else out.unionByName(found)
        rows = counted.filter(F.col("n") > bucket)
        if level < levels and rows.isEmpty():
            break
    return out


def fingerprint_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, rep, component_id): per distinct fingerprint of ``prints`` (doc_id, fp) its own smallest doc_id and
    the smallest one reachable."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprints")
    roots = connected_components(fingerprint_links(nodes.select("fp"), radius))
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    low = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    return linked.join(low, "root").select("fp", "rep", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``."""
    prints = materialize(with_fingerprint(docs.select("doc_id", text), "fp", text, shingle).select("doc_id", "fp"),
                         "simhash")
    parts = fingerprint_components(prints, radius)
    return prints.join(parts, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (all its columns) with one row per component: that of the component's smallest doc_id."""
    column = fresh_name(docs, "simhash")
    # whole rows and fingerprints are written once: the texts are hashed once and the keep list joins narrow
    printed = materialize(with_fingerprint(docs, column, text, shingle), "printed")
    parts = fingerprint_components(printed.select("doc_id", F.col(column).alias("fp")), radius)
    chosen = (parts.filter(F.col("rep").eqNullSafe(F.col("component_id"))).groupBy("component_id")
              .agg(F.min("fp").alias("fp")))
    kept = printed.join(chosen, (printed[column] == chosen.fp) & printed.doc_id.eqNullSafe(chosen.component_id),
                        "left_semi")
    return kept.dropDuplicates(["doc_id", column]).select(*docs.columns)


def op3_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
