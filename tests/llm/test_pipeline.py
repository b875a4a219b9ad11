"""The corpus pipeline, stage by stage, against plain Python on the smoke tables."""

import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from test_operators import slow_components, slow_fingerprint

import corpus_pipeline as C
from kestrel.llm import decontam, line_crf, pfair_mix, token_records
from kestrel.session import materialize


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_are_those_of_documents(stages):
    assert [df.columns for df in stages[1:-1]] == [stages[0].columns] * 4
    assert [name for name, _ in C.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination",
                                              "source_mixing", "token_output"]


def test_quality_and_decontamination_take_effect(spark, stages):
    docs, good, single, clean = stages[:4]
    model = line_crf.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert ids(good) == ids(line_crf.score_documents(docs, model).filter("predicted = 1"))
    leaks = {r.doc_id for r in decontam.find_leaks(single, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert leaks and ids(clean) == sorted(set(ids(single)) - leaks)


def test_one_of_each_near_duplicate_group_stays(stages):
    rows = stages[1].select("doc_id", "text").collect()
    comps = slow_components([r.doc_id for r in rows], [slow_fingerprint(r.text) for r in rows])
    assert ids(stages[2]) == sorted(set(comps))


def test_mixing_orders_and_tokens_follow(stages):
    clean, mixed, tokens = stages[3:]
    assert ids(mixed) == ids(clean)
    places = [r.doc_id for r in pfair_mix.mix(clean).orderBy("place").collect()]
    got = tokens.orderBy("start").collect()
    assert [r.doc_id for r in got] == places
    encoder = token_records.PieceEncoder(token_records.default_tokenizer(), 0)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    start = 0
    for r in got:
        tokens_of = [*encoder.plain.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(tokens_of), zlib.crc32(np.array(tokens_of, "<u4").tobytes()))
        start += len(tokens_of)


def test_run_is_the_stages_in_turn(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF_SMALL).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_rows_that_are_not_in_files_go_by_doc_id(spark):
    docs = spark.createDataFrame([(2, "b"), (1, "a c")], "doc_id long, text string")
    assert [r.doc_id for r in C.token_output(spark, docs, "").orderBy("start").collect()] == [1, 2]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, Place long, fp long"


def through(spark, rows):
    """All stages over a table with extra columns whose names clash with the operators' own."""
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in C.STAGES:
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF_SMALL), f"odd-{name}")
        assert name == "token_output" or docs.columns == columns
    return docs.collect()


def test_odd_tables_pass_through_all_stages(spark):
    good = "The river ran past the old mill and the children played there until the evening bell was heard."
    texts = [None, "", " \n", good, good, good + " Then it rained.", "w " * 30_000, "x" * 70_000, "é　ü", "a <|endoftext|> b"]
    rows = [(i, t, None, "s" if i % 2 else None, 1, 5, 6, 7) for i, t in enumerate(texts)]
    rows += [(None, good, "en", "s", 1, 5, 6, 7), (3, good, None, "s", 1, 5, 6, 7), (None, None, None, None, None, None, None, None)]
    got = through(spark, rows)
    assert len({r.start for r in got}) == len(got) and {r.doc_id for r in got} <= {None, *range(len(texts))}
    assert through(spark, []) == []
