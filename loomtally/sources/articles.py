"""Articles from lines: fixed-length prefix, title, marker, text, fixed-length suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.defaults import ARTICLE_MARKER, ARTICLE_PREFIX_CHARS, ARTICLE_SUFFIX_CHARS
from loomtally.sources.strict import keep_valid


def parse_articles(lines: DataFrame, mode: str = "fail", line: str = "value") -> DataFrame:
    """`title` and `text` of each line, plus the other columns of `lines`.

    The first marker splits the line. Prefix and suffix are cut off by length alone;
    a line without marker, or too short for both, is malformed.
    """
    value = F.col(line)
    marker = F.instr(value, ARTICLE_MARKER)
    title_chars = marker - 1 - ARTICLE_PREFIX_CHARS
    text_start = marker + len(ARTICLE_MARKER)
    text_chars = F.length(value) - ARTICLE_SUFFIX_CHARS - text_start + 1
    sound = keep_valid(
        lines,
        (title_chars >= 0) & (text_chars >= 0),
        F.concat(F.lit("malformed article line: "), F.substring(F.coalesce(value, F.lit("NULL")), 1, 80)),
        mode,
    )
    return sound.select(
        *[c for c in lines.columns if c != line],
        F.substring(value, F.lit(ARTICLE_PREFIX_CHARS + 1), title_chars).alias("title"),
        F.substring(value, text_start, text_chars).alias("text"),
    )


def read_articles(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    return parse_articles(spark.read.text(path), mode)
