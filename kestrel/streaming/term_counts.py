"""Term counts over a growing folder of article-line files (Structured Streaming).

The same parse and count as the batch ranking, on ``readStream``: each micro-batch
is map-side combined into (term, partial count) pairs, and the streaming state
holds one row per listed term -- bounded by the term list, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kestrel.operators.ranking import term_counts
from kestrel.session import scratch_path
from kestrel.sources.articles import parse_article_lines


def stream_term_counts(spark: SparkSession, path: str, terms: Sequence[str], *, line_sep: str | None = None,
                       max_files_per_trigger: int | None = None, on_error: str = "raise") -> DataFrame:
    """Streaming ``(term, n)``: articles mentioning each listed term, over all files seen so far."""
    reader = spark.readStream.format("text")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    articles = parse_article_lines(reader.load(path), "value", on_error=on_error)
    return term_counts(articles, terms)


def start_term_counts(counts: DataFrame, *, query_name: str, checkpoint_location: str | None = None,
                      sink: str = "memory", output_mode: str = "complete", **options) -> StreamingQuery:
    """Start the query; progress is checkpointed in the shared checkpoint folder by default."""
    location = checkpoint_location or scratch_path(counts.sparkSession, f"stream-{query_name}")
    writer = (counts.writeStream.outputMode(output_mode).format(sink).queryName(query_name)
              .option("checkpointLocation", location))
    for k, v in options.items():
        writer = writer.option(k, v)
    return writer.start()
