"""Posting CSV parser.

A line is ``postingType,id,acceptedAnswer,parentId,score[,tag[,...]]``: plain comma
split, no quoting.  Empty acceptedAnswer/parentId -> null; the tag is the 6th field
if present; fields after the 6th are ignored.  Trailing empty fields do not count
(``"2,5,,1,3,"`` has no tag).  A line with fewer than five fields, or a required
field that is not an integer, fails the job (explicit checks, independent of the
session's ANSI setting); a short line fails as soon as its id or score is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING_SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType(), True),
    T.StructField("id", T.LongType(), True),
    T.StructField("accepted_answer", T.LongType(), True),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("score", T.IntegerType(), True),
    T.StructField("tags", T.StringType(), True),
])

POSTING_COLUMNS = [f.name for f in POSTING_SCHEMA.fields]


def parse_postings(lines: DataFrame, line_col: str = "value", *, keep: list[str] | None = None) -> DataFrame:
    """``(*keep, posting_type, id, accepted_answer, parent_id, score, tags)`` per line."""
    keep = list(keep or [])
    # split once in its own projection: referenced from inside CASE branches, the
    # split would otherwise be evaluated again for every field
    split = lines.select(*keep, F.col(line_col).alias("_line"),
                         F.split(F.rtrim(F.col(line_col), F.lit(",")), ",").alias("_f"))
    fields = F.col("_f")
    n = F.size(fields)
    line = F.substring(F.col("_line"), 1, 80)
    short = F.raise_error(F.concat(F.lit("malformed posting line (fewer than 5 fields): "), line))

    # integers are checked explicitly (try_cast + raise), so a malformed field fails
    # the job whatever the session's ANSI setting
    def to_int(text: Column, type_name: str, what: str) -> Column:
        value = text.try_cast(type_name)
        bad = F.raise_error(F.concat(F.lit(f"malformed posting line ({what} is not an integer): "), line))
        return F.when(value.isNotNull() | text.isNull(), value).otherwise(bad)

    def required(i: int, type_name: str, what: str) -> Column:
        return F.when(n >= 5, to_int(F.get(fields, i), type_name, what)).otherwise(short)

    def optional(i: int, type_name: str, what: str) -> Column:
        return to_int(F.nullif(F.get(fields, i), F.lit("")), type_name, what)

    return split.select(
        *keep,
        # the type is cut without the split: filters on it are pushed below this
        # projection by Catalyst and then cost a substring, not a second split
        to_int(F.substring_index(F.col("_line"), ",", 1), "int", "posting type").alias("posting_type"),
        required(1, "bigint", "id").alias("id"),
        optional(2, "bigint", "accepted answer").alias("accepted_answer"),
        optional(3, "bigint", "parent id").alias("parent_id"),
        required(4, "int", "score").alias("score"),
        F.when(n >= 6, F.get(fields, 5)).alias("tags"),
    )
