"""Training-corpus pipeline: quality, near-duplicates, decontamination, mixing, token output.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of ``documents``.  ``run`` writes each stage as Parquet below the shared checkpoint folder and
reads it again as the next one's ``docs``, so a lost executor never costs more than one stage.

The mixture is an order, not a selection: the stage keeps every document and lays the rows out in mixed order,
and the token stage writes its records in the order of the rows in those files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import decontam, line_crf, pfair_mix, simhash_dedup, token_records
from kestrel.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, trained on the labelled ones among ``docs``, does not reject."""
    return line_crf.keep_good(docs, line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    return simhash_dedup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mixture of their sources."""
    return pfair_mix.in_mixed_order(docs)


def _file_order(docs: DataFrame) -> list[Column] | None:
    """The order of rows in the files that ``docs`` reads; None (ascending doc_id) if it does not read files."""
    order = [*token_records.file_order(F.col("_metadata.file_name")), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return None
    return order


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents in their order; return the record index."""
    return token_records.token_records(docs, order=_file_order(docs)).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mixture),
    ("token_output", token_output),
]

#: SQL can express neither the trained model nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
