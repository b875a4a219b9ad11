"""Streaming term counts: files arriving in a folder update bounded per-term state."""

from conftest import rows
from kestrel.session import scratch_path
from kestrel.sources.lines import write_lines
from kestrel.streaming.term_counts import start_term_counts, stream_term_counts


def article_lines(spark, pairs):
    return spark.createDataFrame(
        [(f"<page> <title>{t}</title><text>{body}</text>  </page>",) for t, body in pairs], "line string")


def test_counts_follow_new_files(spark):
    folder = scratch_path(spark, "stream-in")
    write_lines(article_lines(spark, [("1", "Scala is great"), ("2", "Java and\nScala")]), "line",
                f"{folder}/batch1", line_sep="\x1e")
    counts = stream_term_counts(spark, f"{folder}/*", ["Scala", "Java"], line_sep="\x1e")
    q = start_term_counts(counts, query_name="kestrel_stream_test")
    try:
        q.processAllAvailable()
        # newline is not a token separator: "and\nScala" does not mention Scala
        assert sorted(rows(spark.table("kestrel_stream_test"))) == [("Java", 1), ("Scala", 1)]
        write_lines(article_lines(spark, [("3", "Java rocks"), ("4", "Scala Java")]), "line",
                    f"{folder}/batch2", line_sep="\x1e")
        q.processAllAvailable()
        assert sorted(rows(spark.table("kestrel_stream_test"))) == [("Java", 3), ("Scala", 2)]
    finally:
        q.stop()
