"""Line sources and parsers: article lines and posting CSV."""

import pytest

from conftest import raises_spark, rows
from kestrel.session import scratch_path
from kestrel.sources.articles import parse_article_lines
from kestrel.sources.lines import read_lines, write_lines
from kestrel.sources.postings import POSTING_COLUMNS, parse_postings


def lines_df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_article_line_round_trip(spark):
    df = lines_df(spark, ["<page> <title>Scala</title><text>Scala is great</text>  </page>"])
    assert rows(parse_article_lines(df)) == [("Scala", "Scala is great")]


def test_article_prefix_and_suffix_are_counted_not_matched(spark):
    df = lines_df(spark, ["ABCDEFGHIJKLMNT</title><text>body1234567890123456"])
    assert rows(parse_article_lines(df)) == [("T", "body")]


def test_article_line_without_separator(spark):
    df = lines_df(spark, ["<page> <title>x no separator here</text>  </page>"])
    raises_spark(lambda: parse_article_lines(df).collect(), "malformed article line")
    assert rows(parse_article_lines(df, on_error="drop")) == []


def test_article_line_too_short(spark):
    # separator inside the 14-char prefix
    df = lines_df(spark, ["ab</title><text>xxxxxxxxxxxxxxxxxxxx"])
    raises_spark(lambda: parse_article_lines(df).collect(), "malformed article line")


def test_text_source_round_trip_with_record_separator(spark):
    df = lines_df(spark, ["a\nb", "c", "d e"])
    path = write_lines(df, "value", scratch_path(spark, "t-lines"), line_sep="\x1e")
    assert sorted(rows(read_lines(spark, path, line_sep="\x1e"))) == [("a\nb",), ("c",), ("d e",)]


def test_missing_text_path_raises(spark):
    with pytest.raises(Exception):
        read_lines(spark, "/tmp/definitely-not-here-kestrel/x.txt").collect()


def test_posting_fields(spark):
    df = lines_df(spark, ["1,27233496,,,0,C#", "2,23698767,,9002525,2", "1,5484340,5494879,,0,JavaScript"])
    got = rows(parse_postings(df), *POSTING_COLUMNS)
    assert got == [(1, 27233496, None, None, 0, "C#"), (2, 23698767, None, 9002525, 2, None),
                   (1, 5484340, 5494879, None, 0, "JavaScript")]


def test_posting_trailing_and_extra_fields(spark):
    df = lines_df(spark, ["2,234,,123,5", "2,234,,123,5,", "1,9,,,3,a,b", "1,9,,,3,,x"])
    got = rows(parse_postings(df), "tags")
    assert got == [(None,), (None,), ("a",), ("",)]


def test_posting_bad_int_raises(spark):
    from conftest import conf_override
    for ansi in ("true", "false"):
        with conf_override(spark, spark__sql__ansi__enabled=ansi):
            raises_spark(lambda: parse_postings(lines_df(spark, ["x,1,,,0"])).collect(), "posting type is not")
            raises_spark(lambda: parse_postings(lines_df(spark, ["1,1,,,zz"])).collect(), "score is not")
            raises_spark(lambda: parse_postings(lines_df(spark, ["2,1,,p,3"])).collect(), "parent id is not")
            assert rows(parse_postings(lines_df(spark, ["2,1,, 7,3"])), "parent_id") == [(7,)]


def test_posting_too_few_fields_raises(spark):
    raises_spark(lambda: parse_postings(lines_df(spark, ["1,2,,,"])).collect(), "malformed posting line")
