"""Token-id output as length-delimited binary records with masked checksums, and a separate offset index.

A record is

    u64 length of payload | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of payload | newline

all little-endian; the payload is ``i64 doc_id`` (NULL_ID for null) and the ids, two bytes each where the vocabulary
has at most 65,536 entries, else four.  The newline is part of the frame: Spark's text writer puts it
there, so files are written by ordinary Spark tasks through the Hadoop committer (any file system,
attempts of lost executors never become visible).  Files hold the documents in ascending order, one
range of the order per file, so ``part-00000`` comes first.

The offset index (Parquet below ``<path>/index``) has a row per record: doc_id, file, offset,
length, n_tokens, start, ids_crc32; ``read_records_at`` fetches records in any order by it.

Tokens: a space between two non-space characters always starts a new piece of the byte-level
vocabulary, so texts are cut there and each distinct piece is encoded once per worker
process by the tokenizers library.  The ids are those of encoding the whole text with the library and
``add_special_tokens=False``; a text that holds the string of an added token (whose id the library puts there) goes
through the library whole, and so does every text if the tokenizer normalises texts first.

Defined cases: null and empty texts have the end id only; null doc_ids come first; rows with equal
doc_ids stand in the order of a hash of their texts; other columns are ignored; an empty table
writes no record and gives an empty index.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kestrel.llm.bytesvec import SegmentHasher, chunks, lean, ragged, utf8_of
from kestrel.llm.common import bounded_batches, per_worker
from kestrel.session import scratch_path

END_ID = 0
NULL_ID = -(1 << 63)
HEAD, HEAD_SIZE = "<QI", 12
TAIL, TAIL_SIZE = "<I", 4
DOC, DOC_SIZE = "<q", 8
MASK_DELTA = 0xA282EAD8
#: Distinct pieces remembered per worker process (about 40 bytes each); beyond it the memory starts anew.
MEMO = 1_500_000
#: ASCII white space and control characters; first bytes of other characters that may be white space.
MAYBE_SPACE = np.arange(256) <= 0x20
LEADS_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: Text bytes per record file.
FILE_BYTES = 32 << 20


def masked_crc(data: bytes) -> int:
    """CRC-32 rotated right by 15 bits plus a constant, so that a checksum of checksummed data stays sound."""
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without its closing newline."""
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(TAIL, masked_crc(length)) + payload + struct.pack(TAIL, masked_crc(payload))


def records_of(data) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record of a file's bytes; raises ValueError on any damage."""
    at, view = 0, memoryview(data)
    while at < len(view):
        if at + HEAD_SIZE > len(view):
            raise ValueError(f"truncated record head at {at}")
        length, check = struct.unpack_from(HEAD, data, at)
        if masked_crc(view[at:at + 8]) != check:
            raise ValueError(f"bad length checksum at {at}")
        end = at + HEAD_SIZE + length
        if end + TAIL_SIZE + 1 > len(view):
            raise ValueError(f"truncated record at {at}")
        payload = view[at + HEAD_SIZE:end]
        if masked_crc(payload) != struct.unpack_from(TAIL, data, end)[0] or view[end + TAIL_SIZE] != 10:
            raise ValueError(f"bad payload checksum at {at}")
        yield at, payload
        at = end + TAIL_SIZE + 1


class PieceEncoder:
    """Encodes texts to packed ids; every distinct piece goes through the library once per worker process.

    A text is cut at each space between two characters that are certainly not white space: there the
    vocabulary's pattern always starts a new token.  Pieces are told apart by 64-bit hashes of their bytes;
    new ones are encoded many at a time, joined, and cut apart again by the byte lengths of their tokens."""

    STEP = 200  # pieces per call of the library

    def __init__(self, tokenizer_path: str, end_id: int):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content.encode() for t in self.plain.get_added_tokens_decoder().values() if t.content]
        self.tok = Tokenizer.from_file(tokenizer_path)
        self.tok.encode_special_tokens = True  # joined pieces never stand for an added token
        vocab = self.tok.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocab) <= 1 << 16 else "<u4")
        self.sizes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token)  # a byte-level token has one character per byte
        self.end = np.array([end_id], dtype=self.dtype)
        self.hasher = SegmentHasher(2)
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # hashes of the pieces, sorted; first and count run along with them
        self.first = self.count = np.empty(0, np.int64)
        self.ids = np.empty(0, self.dtype)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, raw: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids, and ids per piece, of pieces that may stand next to each other."""
        out, counts = [], []
        for i in range(0, len(begin), self.STEP):
            b, e = begin[i:i + self.STEP], end[i:i + self.STEP]
            part = [raw[x:y] for x, y in zip(b.tolist(), e.tolist())]
            ids, = self._library([b"".join(part).decode()])
            at, ends = np.cumsum(self.sizes[ids]), np.cumsum(e - b)
            cut = np.searchsorted(at, ends)
            if len(at) <= cut[-1] or not np.array_equal(at[cut], ends):  # not a byte-level vocabulary of this kind
                each = self._library([p.decode() for p in part])
                out += each
                counts.append(np.array([len(x) for x in each]))
            else:
                out.append(ids)
                counts.append(np.diff(np.r_[-1, cut]))
        return out, counts

    def _learn(self, hashes: np.ndarray, raw: bytes, begin: np.ndarray, end: np.ndarray, joins: np.ndarray) -> None:
        alone = self._library([raw[b:e].decode() for b, e in zip(begin[~joins].tolist(), end[~joins].tolist())])
        ids, counts = self._joined(raw, begin[joins], end[joins])
        order = np.argsort(np.r_[np.flatnonzero(joins), np.flatnonzero(~joins)])
        counts = np.concatenate([*counts, np.array([len(x) for x in alone], dtype=np.int64)]).astype(np.int64)
        first = len(self.ids) + np.cumsum(counts) - counts
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.first = np.insert(self.first, at, first[order])
        self.count = np.insert(self.count, at, counts[order])
        self.ids = np.concatenate([self.ids, *ids, *alone])

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Texts that cannot be cut: those that hold the string of an added token."""
        if self.plain.normalizer is not None:
            return list(range(len(offsets) - 1))
        raw, hits = data.tobytes(), []
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                hits.append(at)
                at = raw.find(token, at + 1)
        return np.unique(np.searchsorted(offsets, hits, "right") - 1).tolist()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of each text, with the end id."""
        out = self._by_pieces(data, offsets)
        for i in self._whole(data, offsets):
            text = data[offsets[i]:offsets[i + 1]].tobytes().decode()
            ids = self.plain.encode(text, add_special_tokens=False).ids
            out[i] = np.array(ids, dtype=self.dtype).tobytes() + self.end.tobytes()
        return out

    def _by_pieces(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        n = len(offsets) - 1
        if not len(data):
            return [self.end.tobytes()] * n
        if len(self.known) > MEMO:
            self.forget()
        # cut before a space whose neighbours cannot be white space, and at every text
        space = np.flatnonzero(data == 0x20)
        padded = np.pad(data, 3, constant_values=0x20)
        behind, ahead = [padded[space + 3 - k] for k in (1, 2, 3)], padded[space + 4]
        ends_well = ~(MAYBE_SPACE[behind[0]] | ((behind[1] == 0xC2) & ((behind[0] == 0x85) | (behind[0] == 0xA0)))
                      | ((behind[2] >= 0xE1) & (behind[2] <= 0xE3) & (behind[0] >= 0x80)))
        cut = space[ends_well & ~MAYBE_SPACE[ahead] & ~LEADS_SPACE[ahead]]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts = np.sort(np.r_[cut, heads], kind="stable")
        starts = starts[np.r_[True, starts[1:] != starts[:-1]]]
        lengths = np.diff(np.r_[starts, len(data)])
        hashes = self.hasher(data, starts, lengths)
        order = np.argsort(hashes)
        edge = np.r_[True, np.diff(hashes[order]) != 0]
        distinct, where = hashes[order][edge], order[edge]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(edge) - 1
        slots = np.searchsorted(self.known, distinct)
        new = np.flatnonzero(self.known[np.minimum(slots, len(self.known) - 1)] != distinct) if len(self.known) else \
            np.arange(len(distinct))
        if len(new):
            at = where[new]
            begin, end = starts[at], starts[at] + lengths[at]
            is_cut = np.zeros(len(data) + 1, dtype=bool)
            is_cut[cut] = True
            tail = data[end - 1]
            joins = is_cut[begin] & (is_cut[end] | (tail < 0x80) & ~MAYBE_SPACE[tail])
            self._learn(distinct[new], data.tobytes(), begin, end, joins)
            slots = np.searchsorted(self.known, distinct)
        slots = slots[inverse]
        counts = self.count[slots]
        ids = self.ids[ragged(self.first[slots], counts)]
        total = np.r_[0, np.cumsum(counts)][np.searchsorted(starts, offsets)]  # ids before each text
        return [ids[a:b].tobytes() + self.end.tobytes() for a, b in zip(total[:-1].tolist(), total[1:].tolist())]


def write_records(docs: DataFrame, path: str, tokenizer_path: str, *, order: list[Column] | None = None,
                  text: str = "text", end_id: int = END_ID, files: int | None = None) -> None:
    """Write the ids of all texts below ``path`` in the given order (ascending doc_id unless told otherwise)."""
    order = [F.col("doc_id"), F.xxhash64(text)] if order is None else order
    bounded_batches(docs.sparkSession)
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    names = [f"k{i}" for i in range(len(keys))]
    if files is None:
        total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        files = max(1, -(-total // FILE_BYTES))
    ranged = (docs.select(F.col("doc_id").alias("d"), F.col(text).alias("t"), *keys)
              .repartitionByRange(files, *names).sortWithinPartitions(*names).select("d", "t"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker((tokenizer_path, end_id), lambda: PieceEncoder(tokenizer_path, end_id))
        for batch in lean(batches):
            data, offsets = utf8_of(batch.column(1))
            for i, j in chunks(offsets):
                ids = encoder.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([frame(struct.pack(DOC, NULL_ID if d is None else d) + x)
                               for d, x in zip(batch.column(0).slice(i, j - i).to_pylist(), ids)], pa.binary())],
                    names=["value"])

    # the text writer writes the bytes of a string as they are; the cast does not touch them
    ranged.mapInArrow(encode, "value binary").select(F.col("value").cast("string")).write.text(f"{path}/data")


def file_order(name: Column) -> list[Column]:
    """Sort keys of the file names of Spark's writers, ``part-<task>-<id>-c<file of the task>``: by their numbers, since
    as text ``part-100000`` comes before ``part-99999``."""
    return [F.regexp_extract(name, p, 1).try_cast("long") for p in (r"part-(\d+)", r"-c(\d+)")] + [name]


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))


def width_of(tokenizer_path: str) -> int:
    """Bytes per id."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4


def build_index(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Scan the record files once, check every checksum, write and return the offset index."""
    kind = f"<u{width}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):  # a file at a time
                rows: list[tuple] = []
                start = 0
                for offset, payload in records_of(content.as_buffer()):
                    ids = np.frombuffer(payload, dtype=kind, offset=DOC_SIZE).astype("<u4")
                    doc_id = struct.unpack_from(DOC, payload)[0]
                    rows.append((None if doc_id == NULL_ID else doc_id, offset, len(payload), len(ids), start,
                                 zlib.crc32(ids.tobytes())))
                    start += len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(rows)), *(pa.array(c, pa.int64()) for c in zip(*rows))],
                        names=["file", "doc_id", "offset", "length", "n_tokens", "in_file", "ids_crc32"])

    _parsed(spark, path).mapInArrow(
        scan, "file string, doc_id long, offset long, length long, n_tokens long, in_file long, ids_crc32 long"
    ).write.parquet(f"{path}/offsets")
    found = spark.read.parquet(f"{path}/offsets")
    # one row per file: the numbers in the file names are in the order of the documents
    per_file = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = per_file.select("file", F.coalesce(F.sum("n").over(
        W.orderBy(*file_order(F.col("file"))).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    found.join(before, "file").select("doc_id", "file", "offset", "length", "n_tokens",
                                      (F.col("before") + F.col("in_file")).alias("start"),
                                      "ids_crc32").write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_records_at(wanted: DataFrame, path: str, width: int) -> DataFrame:
    """doc_id, ids of the index rows ``wanted`` (any subset, any order): each file is opened once."""
    kind = f"<u{width}"
    spots = wanted.groupBy("file").agg(F.collect_list("offset").alias("offsets"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for content, offsets in zip(batch.column(0), batch.column(1).to_pylist()):
                data = memoryview(content.as_buffer())
                rows = []
                for at in sorted(offsets):
                    length = struct.unpack_from(HEAD, data, at)[0]
                    _, payload = next(records_of(data[at:at + HEAD_SIZE + length + TAIL_SIZE + 1]))
                    doc_id = struct.unpack_from(DOC, payload)[0]
                    rows.append((None if doc_id == NULL_ID else doc_id,
                                 np.frombuffer(payload, dtype=kind, offset=DOC_SIZE).astype(np.int32).tolist()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])

    spark = wanted.sparkSession
    return _parsed(spark, path).join(spots, "file").select("content", "offsets").mapInArrow(
        fetch, "doc_id long, ids array<int>")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_records(docs: DataFrame, tokenizer_path: str | None = None, *, order: list[Column] | None = None) -> DataFrame:
    """Write ``docs`` to a fresh folder below the shared checkpoint folder, read the files back, return the index."""
    spark, tokenizer_path = docs.sparkSession, tokenizer_path or default_tokenizer()
    path = scratch_path(spark, "records")
    write_records(docs, path, tokenizer_path, order=order)
    return build_index(spark, path, width_of(tokenizer_path))


def op2_token_records(spark, sf_dir: str) -> DataFrame:
    """Start, token count and checksum of every document, read back from the record files."""
    index = token_records(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
