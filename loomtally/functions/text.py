"""Whole-token matching of vocabulary terms in text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SPACE = " "

# Comparing each token with every term is faster than hashing it up to about this many.
COMPARE_UP_TO = 32


def check_vocabulary(vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary as a list; a repeated term would be counted twice."""
    terms = list(vocabulary)
    if not terms or any(not isinstance(term, str) for term in terms):
        raise ValueError("a vocabulary is a non-empty sequence of strings")
    if len(set(terms)) != len(terms):
        raise ValueError("vocabulary terms must be distinct")
    return terms


def tokens(text: Column, *, drop_trailing_empty: bool = False) -> Column:
    """Tokens between single spaces; punctuation and newlines stay attached.

    Empty tokens only matter when the empty string itself is looked for; those at the
    end of a non-empty text then do not count.
    """
    if not drop_trailing_empty:
        return F.split(text, SPACE)
    trimmed = F.rtrim(text)
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, SPACE))
    )


def mentions(text: Column, term: str) -> Column:
    """True where the text holds the term as a whole token; NULL text never does.

    Looking for the term between two spaces in the padded text needs no tokens.
    """
    if term == "":
        found = F.array_contains(tokens(text, drop_trailing_empty=True), term)
    elif SPACE in term:
        found = F.lit(False)
    else:
        padded = F.concat(F.lit(SPACE), text, F.lit(SPACE))
        found = F.contains(padded, F.lit(f"{SPACE}{term}{SPACE}"))
    return F.coalesce(found, F.lit(False))


def _quoted(term: str) -> str:
    escaped = term.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def term_rows(articles: DataFrame, text: str, vocabulary: Sequence[str], *keep: str) -> DataFrame:
    """One row per article and distinct vocabulary term in it: `term` and the `keep` columns.

    Each text is tokenised once. A short vocabulary is compared term by term in compiled
    code; a long one becomes a hash set that every token is looked up in, so that the cost
    does not grow with it.
    """
    terms = check_vocabulary(vocabulary)
    words = tokens(F.col(text), drop_trailing_empty="" in terms)
    split = articles.select(words.alias("_tokens"), *keep)
    # SQL text, because building literal columns one by one is slow.
    quoted = [_quoted(term) for term in terms]
    if len(terms) <= COMPARE_UP_TO:
        found = [f"CASE WHEN array_contains(_tokens, {term}) THEN {term} END" for term in quoted]
        hits = F.expr(f"explode(array({', '.join(found)}))")
        return split.select(hits.alias("term"), *keep).where("term IS NOT NULL")
    hits = F.expr(f"explode(array_distinct(filter(_tokens, t -> t IN ({', '.join(quoted)}))))")
    return split.select(hits.alias("term"), *keep)
