"""Term matching, rankings and the inverted index."""

import pytest
from pyspark.sql import functions as F

from loomtally.functions.text import COMPARE_UP_TO
from loomtally.operators import terms as T

ARTICLE = "title string, text string"
THREE = [
    ("1", "Groovy is pretty interesting, and so is Erlang"),
    ("2", "Scala and Java run on the JVM"),
    ("3", "Scala is not purely functional"),
]
FIVE = THREE + [
    ("4", "The cool kids like Haskell more than Java"),
    ("5", "Java is for enterprise developers"),
]
EDGES = [
    ("comma", "a, b"), ("newline", "a\nb"), ("double", "a  b"), ("upper", "A b"),
    ("repeated", "a a a"), ("regex", "C++ and C#"), ("empty", ""), ("null", None),
    ("copy", "same text a"), ("copy", "same text a"), ("spaces", "   "), ("trailing", "b "),
]


def tuples(frame):
    return [tuple(row) for row in frame.collect()]


def filler(n):
    return [f"word{i}" for i in range(n)]


def test_one_article_one_mention(rows):
    frame = rows([("title", "Java Jakarta")], ARTICLE)
    assert tuples(T.count_mentions(frame, "Java")) == [(1,)]


@pytest.mark.parametrize(
    "term, titles",
    [
        ("a", ["copy", "copy", "double", "repeated"]),
        ("a,", ["comma"]),
        ("a\nb", ["newline"]),
        ("C++", ["regex"]),
        ("C#", ["regex"]),
        ("a b", []),
        ("", ["double", "empty"]),
    ],
)
@pytest.mark.parametrize("others", [0, COMPARE_UP_TO])
def test_whole_tokens(rows, term, titles, others):
    frame = rows(EDGES, ARTICLE)
    assert sorted(r["title"] for r in T.mentioning(frame, term).collect()) == titles
    index = T.inverted_index(frame, [term, *filler(others)], "title")
    assert sorted(r["title"] for r in index.collect()) == titles


def test_quotes_and_backslashes_in_long_vocabularies(rows):
    frame = rows([("1", "it's a \\n b\"c")], ARTICLE)
    words = ["it's", "\\n", 'b"c', *filler(COMPARE_UP_TO)]
    assert {r["term"] for r in T.inverted_index(frame, words).collect()} == {"it's", "\\n", 'b"c'}


def test_index_has_a_key_per_mentioned_term(rows):
    index = T.inverted_index(rows(THREE, ARTICLE), ["Scala", "Java"], "title")
    assert sorted(tuples(index)) == [("Java", "2"), ("Scala", "2"), ("Scala", "3")]
    assert index.select("term").distinct().count() == 2


def test_rankings(rows):
    frame = rows(FIVE, ARTICLE).withColumn("id", F.col("title").cast("bigint"))
    words = ["Scala", "Java", "Groovy", "Haskell", "Perl"]
    combined = [("Java", 3), ("Scala", 2), ("Groovy", 1), ("Haskell", 1)]
    assert tuples(T.rank_combined(frame, words)) == combined
    assert tuples(T.rank_terms(frame, words)) == combined + [("Perl", 0)]
    assert tuples(T.top_terms(T.term_counts(frame, words), 2)) == combined[:2]
    for span in (1, 2, 100):
        blocks = T.index_blocks(T.inverted_index(frame, words, "id"), "id", span)
        assert tuples(T.rank_from_index(blocks)) == combined


def test_blocks_of_a_common_term_stay_small(spark):
    frame = spark.range(1000).select("id", F.lit("hot").alias("text"))
    blocks = T.index_blocks(T.inverted_index(frame, ["hot"], "id"), "id", 64)
    sizes = [len(r["articles"]) for r in blocks.collect()]
    assert max(sizes) == 64 and sum(sizes) == 1000


def test_negative_ids_fall_in_blocks_of_equal_span(spark):
    frame = spark.range(-10, 10).select("id", F.lit("hot").alias("text"))
    blocks = T.index_blocks(T.inverted_index(frame, ["hot"], "id"), "id", 5)
    assert sorted(len(r["articles"]) for r in blocks.collect()) == [5, 5, 5, 5]


@pytest.mark.parametrize("words", [[], ["a", "a"], ["a", None]])
def test_vocabulary_must_be_distinct_strings(rows, words):
    with pytest.raises(ValueError):
        T.rank_combined(rows(THREE, ARTICLE), words)


@pytest.mark.parametrize("literal_terms", [10_000, 0])
def test_vocabulary_table(rows, spark, monkeypatch, literal_terms):
    monkeypatch.setattr(T, "MAX_LITERAL_TERMS", literal_terms)
    vocabulary = spark.createDataFrame([("Scala",), ("Java",), ("Java",), (None,)], "term string")
    joined = T.mention_join(rows(FIVE + FIVE, ARTICLE), vocabulary, "title")
    expected = [("Java", t) for t in "245"] + [("Scala", t) for t in "23"]
    assert sorted(tuples(joined.select("term", "title"))) == sorted(expected * 2)


def test_empty_vocabulary_table(rows, spark):
    nothing = spark.createDataFrame([], "term string")
    assert T.mention_join(rows(THREE, ARTICLE), nothing, "title").count() == 0
