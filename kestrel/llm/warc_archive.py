"""WARC archives of pages, read back by an index of byte ranges.

Writing: one record per page in ``.warc.zst`` form, a Zstandard frame per record.  Spark's text writer puts a line end
behind every row; here it is an empty skippable frame (its eight bytes are valid text), so the files are
plain concatenations of frames, written by ordinary tasks through the Hadoop committer: attempts of lost
executors never become visible, and any file system will do.

A payload of ``MIN_REVISIT`` bytes or more that several pages share is stored once, in the response of the largest
page_id; the others are revisit records of the profile "identical payload digest" that refer to it.
Shared payloads are counted by SHA-256, combined before the shuffle, so a payload that a third of the pages
hold is one row per task; the pages meet the few shared ones in a join that adaptive execution may split.

Reading, index first: a pass over the files walks the frames by their block headers, unpacks the heads of the records
only and writes offset, length, URL, digest, type and reference of each (``<path>/index``).  ``read_records`` then
takes any rows of that index, sorts them by file and offset, joins neighbouring ranges to single
reads of at most ``RANGE_BYTES`` and yields the records.  Files of the schemes in ``RANGED`` are read by byte range
where the task runs; for others Spark reads whole files (``binaryFile``) and the ranges are cut from those.

Defined cases: a null html is an empty payload; a null URL has no target header, an empty one an empty header, and
control characters and spaces in a URL are percent-encoded; rows that repeat the largest page_id of a shared payload
are responses, all of them; a null page_id comes before all others (pages of a shared payload that all have none are
responses); records of equal page_id and payload have equal record ids; other columns are ignored; an empty table
gives an empty archive, index and result.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import lean
from kestrel.llm.common import bounded_batches, shuffle_partitions
from kestrel.session import scratch_path

MIN_REVISIT = 1000
DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_MAGIC, SKIP_MAGIC = 0xFD2FB528, 0x184D2A50
#: An empty skippable frame: magic 0x184D2A50 and length 0, little-endian.
SEPARATOR = struct.pack("<II", SKIP_MAGIC, 0).decode("ascii")
#: Bytes per read of the index pass; most bytes of joined ranges, and the gap that is read rather than skipped.
WINDOW_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
#: Schemes of files that a task can open by itself.
RANGED = ("", "file", "s3", "s3a", "gs")
INDEX = ("file string, offset long, length long, url string, digest string, type string, record_id string, "
         "refers_to string")


# --- records ----------------------------------------------------------------------------------------------------

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def page_of(record: str) -> int | None:
    """The page_id in a record id."""
    own = record.rsplit(":", 2)[1]
    return int(own) if own else None


def _safe(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: str | None = None,
           date: str = DATE) -> bytes:
    """A response record, or a revisit record if it refers to another; ``digest`` is the payload's SHA-1 in hex."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])}


def parse_head(data: bytes) -> tuple[dict[str, str], int]:
    """(headers by lower-case name, where the block begins) of a record's first bytes."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or end < 0:
        raise ValueError("not a WARC record")
    return _headers(data[:end]), end + 4


def payload_of(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record headers, HTTP headers, payload) of a whole record."""
    headers, begin = parse_head(data)
    end = begin + int(headers["content-length"])
    if data[end:] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('warc-record-id')} does not end where its length says")
    block = data[begin:end]
    cut = block.find(b"\r\n\r\n")
    if cut < 0:
        raise ValueError(f"record {headers.get('warc-record-id')} holds no HTTP response")
    return headers, _headers(block[:cut]), block[cut + 4:]


def digest_hex(header: str) -> str:
    kind, _, value = header.partition(":")
    if kind != "sha1":
        raise ValueError(f"unknown digest {header}")
    return base64.b32decode(value).hex()


# --- frames -----------------------------------------------------------------------------------------------------

def frames(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the data frames of a file, found by their block headers alone."""
    at = 0
    while at < size:
        head = read(at, 8)
        magic, skip = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
        if magic & ~0xF == SKIP_MAGIC:
            at += 8 + skip
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at {at}")
        flags = head[4]
        if flags & 3:
            raise ValueError("frames with a dictionary are not read")
        single = flags >> 5 & 1
        end = at + 6 - single + (single, 2, 4, 8)[flags >> 6]
        last = 0
        while not last:
            block = read(end, 3)
            if len(block) < 3:
                raise ValueError(f"truncated frame at {at}")
            header = int.from_bytes(block, "little")
            last, kind = header & 1, header >> 1 & 3
            end += 3 + (1 if kind == 1 else header >> 3)
        end += 4 if flags & 4 else 0
        if end > size:
            raise ValueError(f"truncated frame at {at}")
        yield at, end - at
        at = end
    if at != size:
        raise ValueError("truncated skippable frame")


def _opened(path: str) -> pa.NativeFile:
    scheme, _, rest = path.partition(":") if ":" in path else ("", "", path)
    if scheme in ("", "file"):
        return pa.fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, inner = pa.fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    return system.open_input_file(inner)


class _Buffered:
    """``read(offset, n)`` over a file by windows, for a pass from its begin to its end."""

    def __init__(self, file: pa.NativeFile, window: int = WINDOW_BYTES):
        self.file, self.window, self.start, self.data = file, window, 0, b""

    def __call__(self, offset: int, n: int) -> bytes:
        if not self.start <= offset <= offset + n <= self.start + len(self.data):
            self.start, self.data = offset, self.file.read_at(max(n, self.window), offset)
        return self.data[offset - self.start:offset - self.start + n]


def _files(spark: SparkSession, path: str, content: bool) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    return found.select(F.col("path").alias("file"), "length", *(["content"] if content else []))


def _ranged(path: str) -> bool:
    return (path.partition(":")[0] if ":" in path else "") in RANGED


# --- writing ----------------------------------------------------------------------------------------------------

def _marked(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, url, body (bytes), digest, of (the largest page_id of the same payload if several pages share it), shared."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body")).withColumn("long", F.octet_length("body") >= min_revisit)
    # short payloads are never shared: their keys only spread them
    key = F.when(F.col("long"), F.sha2("body", 256)).otherwise(F.xxhash64("page_id", "url").cast("string"))
    shared = (rows.filter("long").groupBy(F.sha2("body", 256).alias("key"))
              .agg(F.max("page_id").alias("of"), F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("key", "of", F.lit(True).alias("shared")))
    return rows.withColumn("key", key).join(shared, "key", "left").select(
        "page_id", "url", "body", F.sha1("body").alias("digest"), "of", F.coalesce("shared", F.lit(False)).alias("shared"))


def write_archives(pages: DataFrame, path: str, *, min_revisit: int = MIN_REVISIT, date: str = DATE,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """A record per row of ``pages`` (page_id, url, html) in ``<path>/data``."""
    bounded_batches(pages.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in lean(batches):
            out = []
            for r in batch.to_pylist():
                other = r["shared"] and r["page_id"] != r["of"]
                out.append(pack(record(r["page_id"], r["url"], r["body"], r["digest"],
                                       record_id(r["of"], r["digest"]) if other else None, date)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # the text writer writes the bytes of a string as they are; the cast does not touch them
    (_marked(pages, min_revisit).mapInArrow(encode, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", records_per_file).text(f"{path}/data"))


# --- index and reading ------------------------------------------------------------------------------------------

def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Write and return the INDEX of the archives below ``path``: a row per record."""
    ranged = _ranged(path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()

        def entry(name: str, offset: int, frame: bytes) -> tuple:
            head, reader = b"", unpacker.stream_reader(frame)
            while b"\r\n\r\n" not in head and (more := reader.read(1024)):
                head += more
            h, _ = parse_head(head)
            return (name, offset, len(frame), h.get("warc-target-uri"), digest_hex(h["warc-payload-digest"]), h["warc-type"],
                    h["warc-record-id"], h.get("warc-refers-to"))

        for batch in lean(batches):
            for i, (name, size) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                with _opened(name) if ranged else pa.BufferReader(batch.column(2)[i].as_buffer()) as file:
                    read, rows = _Buffered(file), []
                    for offset, length in frames(read, size):
                        rows.append(entry(name, offset, read(offset, length)))
                        if len(rows) == 10_000:
                            yield _batch(rows, INDEX)
                            rows = []
                    yield _batch(rows, INDEX)

    _files(spark, path, not ranged).mapInArrow(scan, INDEX).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def joined_ranges(spots: Iterator[tuple[int, int]], most: int = RANGE_BYTES, gap: int = GAP_BYTES) -> Iterator[list]:
    """Lists of (offset, length), sorted by offset, that one read each covers."""
    now: list[tuple[int, int]] = []
    for offset, length in spots:
        if now and (offset - sum(now[-1]) > gap or offset + length - now[0][0] > most):
            yield now
            now = []
        now.append((offset, length))
    if now:
        yield now


RECORDS = "page_id long, url string, type string, digest string, refers_to long, payload_bytes long, payload binary"


def read_records(wanted: DataFrame, path: str) -> DataFrame:
    """RECORDS of the index rows ``wanted`` (any subset): a revisit has the length and digest of the payload it refers to
    and a null payload."""
    spark, ranged = wanted.sparkSession, _ranged(path)
    bounded_batches(spark)

    def rows_of(name: str, read: Callable[[int, int], bytes], spots: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for near in joined_ranges(iter(spots)):
            start = near[0][0]
            data, rows = memoryview(read(start, sum(near[-1]) - start)), []
            for offset, length in near:
                h, http, payload = payload_of(unpack(data[offset - start:offset - start + length]))
                refers, revisit = h.get("warc-refers-to"), h["warc-type"] == "revisit"
                if not revisit and len(payload) != int(http["content-length"]):
                    raise ValueError(f"{name}: payload of {h['warc-record-id']} is cut")
                rows.append((page_of(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"],
                             digest_hex(h["warc-payload-digest"]), page_of(refers) if refers else None,
                             int(http["content-length"]), None if revisit else payload))
            yield _batch(rows, RECORDS)

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fetch(name: str, spots: list) -> Iterator[pa.RecordBatch]:
            with _opened(name) as file:
                yield from rows_of(name, lambda offset, n: file.read_at(n, offset), spots)

        name, spots = None, []
        for batch in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if spots and (file != name or len(spots) == 10_000):
                    yield from fetch(name, spots)
                    spots = []
                name = file
                spots.append((offset, length))
        if spots:
            yield from fetch(name, spots)

    def by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for name, content, spots in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = memoryview(content.as_buffer())
                yield from rows_of(name, lambda offset, n, d=data: d[offset:offset + n],
                                   [(s["offset"], s["length"]) for s in spots])

    if not ranged:  # RECORDS_PER_FILE bounds a file's list
        spots = wanted.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("spots"))
        return _files(spark, path, True).join(spots, "file").select("file", "content", "spots").mapInArrow(by_file, RECORDS)
    # a stretch of RANGE_BYTES of a file goes to one task, in order
    stretch = F.expr(f"offset div {RANGE_BYTES}")
    return (wanted.select("file", "offset", "length").repartition(shuffle_partitions(wanted), "file", stretch)
            .sortWithinPartitions("file", "offset").mapInArrow(by_range, RECORDS))


def check_references(index: DataFrame) -> None:
    """Raise if a revisit refers to no response of the same digest.  Equal references are combined first."""
    pointers = index.filter("type = 'revisit'").select("refers_to", "digest").distinct()
    targets = index.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), "digest").distinct()
    if lost := pointers.join(targets, ["refers_to", "digest"], "left_anti").head(1):
        raise ValueError(f"no response {lost[0].refers_to} with digest {lost[0].digest}")


def verified(records: DataFrame) -> DataFrame:
    """``records``; a payload that does not have its digest fails the job."""
    bad = F.raise_error(F.concat(F.lit("payload digest differs: page "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    same = F.col("payload").isNull() | (F.sha1("payload") == F.col("digest"))
    return records.withColumn("digest", F.when(same, F.col("digest")).otherwise(bad.cast("string")))


def op13_warc(spark, sf_dir: str) -> DataFrame:
    """Write the archives of all pages, index them, and read every record back."""
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    index = build_index(spark, path)
    check_references(index)
    return verified(read_records(index, path)).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        "refers_to")


#: DuckDB twin.
OP13_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, count(*) OVER (PARTITION BY body) AS copies, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND copies > 1 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND copies > 1 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""
