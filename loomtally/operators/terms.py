"""Which texts mention which terms: filter, counts, rankings and inverted index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomtally.functions.text import check_vocabulary, mentions, term_rows, tokens

# A vocabulary table up to this many terms becomes an in-plan lookup set.
MAX_LITERAL_TERMS = 10_000
VOCABULARY_COPIES = 32


def mentioning(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """Articles that mention the term."""
    return articles.where(mentions(F.col(text), term))


def count_mentions(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """One row: how many articles mention the term."""
    return mentioning(articles, term, text).agg(F.count("*").alias("n"))


def inverted_index(
    articles: DataFrame, vocabulary: Sequence[str], *keep: str, text: str = "text"
) -> DataFrame:
    """One row per term and mentioning article, with the `keep` columns of the article.

    No shuffle: each article emits its own entries, so a term that occurs in a third of
    all articles is as spread out as the articles are.
    """
    return term_rows(articles, text, vocabulary, *keep)


def id_range(key: str, span: int) -> Column:
    """Block number for integer keys: `span` consecutive keys share one."""
    return F.expr(f"(`{key}` - pmod(`{key}`, {int(span)})) div {int(span)}")


def index_blocks(index: DataFrame, key: str, span: int = 100_000) -> DataFrame:
    """Nested form of the index: term, block and the sorted article keys of that block.

    A block covers `span` consecutive integer keys, so with unique keys no array outgrows
    `span`, however common its term is.
    """
    return index.groupBy("term", id_range(key, span).alias("block")).agg(
        F.sort_array(F.collect_list(key)).alias("articles")
    )


def sorted_ranking(counts: DataFrame) -> DataFrame:
    """Most mentioned first, ties by term."""
    return counts.orderBy(F.desc("n"), "term")


def rank_from_index(blocks: DataFrame) -> DataFrame:
    """Ranking from index blocks; terms without any article are absent."""
    return sorted_ranking(
        blocks.groupBy("term").agg(F.sum(F.size("articles")).cast("bigint").alias("n"))
    )


def term_counts(articles: DataFrame, vocabulary: Sequence[str], text: str = "text") -> DataFrame:
    """Mentioning articles per term, counted map-side: only partial counts are shuffled."""
    return inverted_index(articles, vocabulary, text=text).groupBy("term").agg(
        F.count("*").alias("n")
    )


def rank_combined(articles: DataFrame, vocabulary: Sequence[str], text: str = "text") -> DataFrame:
    """Ranking in one pass; terms without any article are absent."""
    return sorted_ranking(term_counts(articles, vocabulary, text))


def rank_terms(articles: DataFrame, vocabulary: Sequence[str], text: str = "text") -> DataFrame:
    """Ranking in one pass that keeps terms without any article, with count 0."""
    terms = check_vocabulary(vocabulary)
    spark = articles.sparkSession
    listed = spark.range(1).select(F.explode(F.lit(terms)).alias("term"))
    counts = term_counts(articles, terms, text)
    return sorted_ranking(
        listed.join(counts, "term", "left").select(
            "term", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
        )
    )


def top_terms(ranking: DataFrame, n: int) -> DataFrame:
    """The n most mentioned terms."""
    return sorted_ranking(ranking).limit(n)


def mention_join(
    articles: DataFrame, vocabulary: DataFrame, *keep: str, text: str = "text"
) -> DataFrame:
    """Index against a vocabulary held in a table with a `term` column.

    A vocabulary of checked size becomes a lookup set in the plan, and nothing shuffles.
    A larger one is joined on the token: every article contributes its distinct tokens
    under one of several copies of the vocabulary, so that a common token is split.
    """
    terms = vocabulary.select("term").where("term IS NOT NULL").distinct()
    head = terms.limit(MAX_LITERAL_TERMS + 1).collect()
    if not head:
        return inverted_index(articles.where(F.lit(False)), [""], *keep, text=text)
    if len(head) <= MAX_LITERAL_TERMS:
        return inverted_index(articles, [row["term"] for row in head], *keep, text=text)
    words = articles.select(
        F.explode(F.array_distinct(tokens(F.col(text), drop_trailing_empty=True))).alias("term"),
        F.pmod(F.xxhash64(text, *keep), F.lit(VOCABULARY_COPIES)).alias("_copy"),
        *keep,
    )
    copies = F.explode(F.sequence(F.lit(0), F.lit(VOCABULARY_COPIES - 1)).cast("array<bigint>"))
    return words.join(terms.withColumn("_copy", copies), ["term", "_copy"]).drop("_copy")
