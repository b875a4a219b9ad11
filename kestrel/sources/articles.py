"""Article line parser: ``<prefix>title</title><text>body<suffix>`` -> ``(title, text)``.

The prefix (14 chars) and suffix (16 chars) are counted, not matched.  With ``i`` the
0-based index of the first ``</title><text>``: title = ``line[14:i]``,
text = ``line[i+14 : len-16]``.  A line where these bounds do not fit (no separator,
separator inside the prefix, body shorter than the suffix) is malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.constants import LINE_PREFIX_LENGTH, LINE_SUFFIX_LENGTH, TITLE_TEXT_SEPARATOR


def parse_article_lines(lines: DataFrame, line_col: str = "value", *, keep: list[str] | None = None,
                        on_error: str = "raise", prefix_len: int = LINE_PREFIX_LENGTH,
                        suffix_len: int = LINE_SUFFIX_LENGTH) -> DataFrame:
    """``(*keep, title string, text string)`` per line.

    ``on_error='raise'`` fails the job on a malformed line, ``'drop'`` skips it.
    """
    if on_error not in ("raise", "drop"):
        raise ValueError("on_error must be 'raise' or 'drop'")
    keep = list(keep or [])
    sep_len = len(TITLE_TEXT_SEPARATOR)
    # locate the separator once (its own projection), then cut
    located = lines.select(*keep, F.col(line_col).alias("_line"),
                           F.instr(F.col(line_col), TITLE_TEXT_SEPARATOR).alias("_pos"),   # 1-based, 0 if absent
                           F.length(F.col(line_col)).alias("_len"))
    line, pos = F.col("_line"), F.col("_pos")
    title_len = pos - F.lit(prefix_len + 1)
    text_start = pos + F.lit(sep_len)
    text_len = F.col("_len") - F.lit(suffix_len) - (text_start - F.lit(1))
    ok = (pos > 0) & (title_len >= 0) & (text_len >= 0)

    title = F.substring(line, F.lit(prefix_len + 1), title_len)
    text = F.substring(line, text_start, text_len)
    if on_error == "raise":
        bad = F.raise_error(F.concat(F.lit("malformed article line: "), F.substring(line, 1, 80)))
        title = F.when(ok, title).otherwise(bad)
        text = F.when(ok, text).otherwise(bad)
        return located.select(*keep, title.alias("title"), text.alias("text"))
    # drop: a one-element array for good lines, none for bad ones.  Not a filter --
    # Catalyst would push it below ``located`` and search every line again in the scan
    good = F.when(ok, F.array(F.struct(title.alias("title"), text.alias("text"))))
    return located.select(*keep, F.inline(good))
