"""Hard negatives, periodic runs and WARC archives against brute force, and their defined edge cases."""

import hashlib
import io
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.llm import hard_negatives, periodic_runs, warc_archive

# --- 11: hard negatives -----------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id string, rank int"


def slow_negatives(rows):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for anchor in {r for r in kept if r[0] is not None and r[0] % 100 == 0}:
        scored = sorted(((-sum(x * y for x, y in zip(anchor[2], q)), i is None, i or 0, label) for i, label, q in kept
                         if i != anchor[0]))
        positives = [s for s in scored if s[3] == anchor[1]][:5]
        for p in positives:
            near = [s for s in scored if s[3] != anchor[1] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            out += [(anchor[0], None if p[1] else p[2], k + 1, None if n[1] else n[2], -p[0], -n[0])
                    for k, n in enumerate(near)]
    return sorted(out, key=str)


def by_sql(rows, schema, sql, table):
    con = duckdb.connect()
    con.register("given", pa.Table.from_pylist(rows, schema))
    con.execute(f"create table {table} as select * from given")
    return sorted(con.execute(sql).fetchall(), key=str)


def mined(spark, tmp_path, rows):
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((tuple(r) for r in hard_negatives.op11_hard_negatives(spark, str(tmp_path)).collect()), key=str)


def test_hard_negatives_equal_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 32)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 2)
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, rnd.random()]) for _ in range(6)], rnd.randint(0, 3), "x", 0) for i in range(420)]
    rows += [(1000 + i, [0.0] * 6, i % 2, "x", 0) for i in range(30)]  # score 0 with every anchor: ties, windows of 0
    rows += [(2000, [0.0] * 6, 1, "x", 0)]
    rows += [(None, [0.5] * 6, 2, None, None), (7, None, 1, "x", 0), (8, [None] * 6, 1, "x", 0), (9, [math.nan] * 6, 1, "x", 0),
             (10, [math.inf] * 6, 1, "x", 0), (11, [0.5] * 6, None, "x", 0), (12, [], 1, "x", 0), (13, [0.5], 2, "x", 0)]
    rows += [rows[100], rows[100], rows[250], rows[251]]  # repeated rows, an anchor among them
    got = mined(spark, tmp_path, rows)
    assert got == slow_negatives(rows) and len(got) > 100
    assert any(r[4] == 0 for r in got)
    schema = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
    named = [dict(zip(("vec_id", "embedding", "label"), r)) for r in rows]
    assert by_sql(named, schema, hard_negatives.OP11_SQL, "embeddings") == got


def test_hard_negatives_of_an_empty_table(spark, tmp_path):
    assert mined(spark, tmp_path, []) == []


def test_scores_stay_exact_beyond_doubles():
    a = np.array([[2.0 ** 31 + 1, 1.0]])
    assert hard_negatives.scores_of(a, a)[0, 0] == (2 ** 31 + 1) ** 2 + 1
    with pytest.raises(OverflowError):
        hard_negatives.scores_of(a * 2, a)


def test_the_stream_holds_no_more_than_an_anchors_windows():
    """A hot anchor's pairs are read one by one: the iterator has emitted before the last key is made."""
    def keys():
        yield hard_negatives.packed_key(100, 1, 1000, 5, hard_negatives.POSITIVE)
        for i in range(50):
            seen.append(i)
            yield hard_negatives.packed_key(100, 1, 900 - i, 10 + i, hard_negatives.NEGATIVE)

    seen: list[int] = []
    found = hard_negatives.windowed_negatives(keys(), 10, 30, 90)
    assert next(found) == (100, 5, 1, 10, 1000, 900) and seen == [0]
    assert [r[3] for r in found] == list(range(11, 20)) and len(seen) == 50


# --- 12: periodic runs ------------------------------------------------------------------------------------------

def slow_runs(words, exponent=4, least=6):
    """Per period, the maximal stretches that keep it; a stretch belongs to its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in found.items())


def slow_result(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, q, e in runs for i in range(s + q, e)}
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
    best = min(((-(e - s), s, q) for s, q, e in runs), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_periodic_runs_equal_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    texts = [None, "", " \n\t ", "a", "a " * 6, "a " * 5, "a b " * 4, "x " + "é ö\n" * 50 + "y", "z " * 3000]
    for _ in range(300):
        base = [rnd.choice("abcdefgh"[:rnd.randint(1, 8)]) for _ in range(rnd.randint(1, 60))]
        cut, p = rnd.randrange(len(base)), rnd.randint(1, 6)
        texts.append(" ".join(base[:cut] + base[cut:cut + p] * rnd.randint(0, 9) + base[cut:]))
    texts.append(" ".join(f"w{i % 1601}" for i in range(8_000)))
    rows = [(i, t, 5, "r") for i, t in enumerate(texts)] + [(None, "a b " * 9, 5, "r"), (3, "a b " * 9, 5, "r"), (3, "a b " * 9, 5, "r")]
    spark.createDataFrame(rows, "doc_id long, text string, length int, runs string").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = periodic_runs.op12_periodic_runs(spark, str(tmp_path)).drop("n_words").collect()
    assert sorted(map(tuple, got), key=str) == sorted((slow_result(r[0], r[1]) for r in rows), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), max_size=4), st.integers(2, 5), st.integers(1, 8))
def test_runs_of_any_words(texts, exponent, least):
    enc = [" ".join(t).encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(e) for e in enc])].astype(np.int64)
    got = periodic_runs._search(np.frombuffer(b"".join(enc), np.uint8), offsets, exponent, least)
    assert [[(s, q, e) for s, e, q in runs] for _, runs, _ in got] == [slow_runs(t, exponent, least) for t in texts]


def test_a_very_long_text_is_one_run():
    text = " ".join(f"w{i % 7001}" for i in range(200_000)).encode()
    (n, runs, kept), = periodic_runs._search(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 4, 6)
    assert (n, runs, kept) == (200_000, [(0, 200_000, 7001)], b" ".join(text.split()[:7001]))


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(periodic_runs, "HASHER", lambda data, starts, lengths: np.zeros(len(starts), np.uint64))
    texts = [b"a b c d e f g h", b"a b a b a b a b a b"]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    got = list(periodic_runs._search(np.frombuffer(b"".join(texts), np.uint8), offsets, 4, 6))
    assert [runs for _, runs, _ in got] == [[], [(0, 10, 2)]] and got[1][2] == b"a b"


def test_periodic_runs_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.periodic_runs(docs).collect() == []


# --- 13: WARC ---------------------------------------------------------------------------------------------------

BIG, BIGGER = "<p>é</p>" * 150, "<b>x</b>" * 400
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://b/ x\r\ny", BIG), (3, None, "short"), (4, "", "short"),
         (5, "http://c", None), (6, "http://c", ""), (None, "http://n", BIG), (None, "http://m", BIGGER), (None, "http://m", BIGGER),
         (7, "http://z", BIGGER + "!"), (7, "http://z", BIGGER + "!"), (8, "http://long", "y" * 300_000)]


def slow_pages(rows):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == body]
        top = max((x for x in same if x is not None), default=None)
        other = len(body) >= 1000 and page_id != top
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if other else "response", top if other else None))
    return sorted(out, key=str)


def test_archives_hold_every_page(spark, tmp_path):
    spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, key string").repartition(3) \
        .write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, warc_archive.op13_warc(spark, str(tmp_path)).collect()), key=str)
    assert got == slow_pages(PAGES)
    assert sum(r[3] == "revisit" for r in got) == 3
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
    assert by_sql([dict(zip(("page_id", "url", "html"), r)) for r in PAGES], schema, warc_archive.OP13_SQL, "pages") == got


def archive(spark, path, rows=PAGES, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc_archive.write_archives(pages, path, **options)
    return warc_archive.build_index(spark, path)


def test_archives_are_plain_warc_and_the_index_points_into_them(spark, tmp_path):
    index = archive(spark, f"file://{tmp_path}/w", records_per_file=2).collect()
    assert len(index) == len(PAGES) and len({r.file for r in index}) > 3
    for r in index:
        data = open(r.file.removeprefix("file:"), "rb").read()
        headers, http, payload = warc_archive.payload_of(zstandard.decompress(data[r.offset:r.offset + r.length]))
        assert headers["warc-record-id"] == r.record_id and headers.get("warc-target-uri") == r.url
        assert r.type == "revisit" or hashlib.sha1(payload).hexdigest() == r.digest
        # any reader of concatenated frames sees whole records
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert text.count(b"WARC/1.1\r\n") == sum(x.file == r.file for x in index) and text.endswith(b"\r\n\r\n")
    assert "http://b/%20x%0D%0Ay" in {r.url for r in index} and "" in {r.url for r in index}


def test_any_records_are_read_by_range_or_from_whole_files(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/w"
    index = archive(spark, path)
    wanted = index.filter("record_id like '%:8:%' or type = 'revisit'")
    def read():
        return sorted((r.page_id, r.url, r.type, r.refers_to, r.payload_bytes, r.payload and hashlib.sha1(r.payload).hexdigest()
                       == r.digest) for r in warc_archive.verified(warc_archive.read_records(wanted, path)).collect() if r.page_id)
    by_range = read()
    assert by_range == [(1, "http://a/1", "revisit", 9, 1350, None), (2, "http://a/2", "revisit", 9, 1350, None),
                        (8, "http://long", "response", None, 300_000, True)]
    monkeypatch.setattr(warc_archive, "RANGED", ())
    assert read() == by_range


def test_whole_file_index_equals_the_ranged_one(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/w"
    ranged = sorted(map(tuple, archive(spark, path).collect()), key=str)
    monkeypatch.setattr(warc_archive, "RANGED", ())
    rows = archive(spark, f"file://{tmp_path}/v").drop("file", "offset").collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(((r[2], *r[3:]) for r in ranged), key=str)


def test_damage_is_seen(spark, tmp_path):
    index = archive(spark, f"file://{tmp_path}/w", [(1, "u", "x")])
    row = index.first()
    data = bytearray(open(row.file.removeprefix("file:"), "rb").read())
    def scan(b):
        return list(warc_archive.frames(lambda at, n: bytes(b[at:at + n]), len(b)))
    assert scan(data) == [(0, row.length)]
    for bad in (data[:-3], data[1:], data[:row.length - 1]):
        with pytest.raises((ValueError, IndexError)):
            scan(bad)
    with pytest.raises(ValueError):
        warc_archive.check_references(index.withColumn("type", F.lit("revisit")).withColumn("refers_to", F.lit("<x>")))


def test_neighbouring_ranges_are_one_read():
    spots = [(0, 10), (10, 5), (100, 10), (10_000, 1)]
    assert list(warc_archive.joined_ranges(iter(spots), most=1000, gap=90)) == [spots[:3], spots[3:]]
    assert list(warc_archive.joined_ranges(iter(spots), most=14, gap=90)) == [[x] for x in spots]


def test_an_empty_table_gives_an_empty_archive(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc_archive.op13_warc(spark, str(tmp_path)).collect() == []
