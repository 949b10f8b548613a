"""Pairing, nesting, scoring and vectors of postings."""

import pytest
from pyspark.sql import functions as F

from loomtally.operators import questions as Q, skew

SCHEMA = "posting_type int, id int, accepted_answer int, parent_id int, score int, tags string"
POSTINGS = [
    (1, 10, 12, None, 7, "Java"),
    (1, 11, None, None, 0, "Erlang"),
    (1, 13, None, None, 2, None),
    (1, 20, None, None, 1, "PHP"),
    (1, 0, None, None, 9, "Perl"),
    (2, 12, None, 10, 5, None),
    (2, 14, None, 10, -3, None),
    (2, 16, None, 10, 5, None),
    (2, 15, None, None, 4, None),
    (2, 17, None, 11, -1, None),
    (2, 18, None, 11, -7, None),
    (2, 19, None, 999, 50, None),
    (2, 21, None, 13, 2, None),
    (3, 16, None, 10, 100, None),
]
PAIRS = [(0, 15), (10, 12), (10, 14), (10, 16), (11, 17), (11, 18), (13, 21)]
BEST = [(0, 4), (10, 5), (11, 0), (13, 2)]


def ids(pairs):
    return sorted(tuple(r) for r in pairs.select("qid", "answer.id").collect())


@pytest.mark.parametrize("limit", [5_000_000, 2, 1])
def test_pairs(rows, limit):
    pairs = Q.qa_pairs(rows(POSTINGS, SCHEMA), limit)
    assert ids(pairs) == PAIRS
    assert {(r.qid, r.tags) for r in pairs.select("qid", "question.tags").collect()} == {
        (0, "Perl"), (10, "Java"), (11, "Erlang"), (13, None)
    }


def test_duplicate_questions_multiply_pairs_but_score_once(rows):
    twice = POSTINGS + [(1, 10, None, None, 3, "Scala")]
    assert len(ids(Q.qa_pairs(rows(twice, SCHEMA), 1))) == len(PAIRS) + 3
    best = Q.best_answer(rows(twice, SCHEMA)).where("id = 10").collect()
    assert [(r.score, r.tags, r.high_score) for r in best] == [(3, "Scala", 5)]


@pytest.mark.parametrize("per_block", [50_000, 2])
def test_nested_pairs(rows, per_block):
    grouped = Q.qa_grouped(rows(POSTINGS, SCHEMA), per_block)
    assert ids(grouped.select("qid", F.inline("pairs"))) == PAIRS
    sizes = {}
    for r in grouped.collect():
        sizes[r.qid] = sizes.get(r.qid, 0) + len(r.pairs)
    assert sizes == {0: 1, 10: 3, 11: 2, 13: 1}
    assert {r.qid for r in Q.with_answer_to(grouped, 10).collect()} == {10}
    assert Q.with_answer_to(grouped, 20).count() == 0


def test_best_answer(rows):
    best = Q.best_answer(rows(POSTINGS, SCHEMA))
    assert sorted((r.id, r.high_score) for r in best.collect()) == BEST
    assert best.columns == [*Q.COLUMNS, "high_score"]
    assert {r.posting_type for r in best.collect()} == {1}


def test_vectors(rows):
    scored = Q.best_answer(rows(POSTINGS, SCHEMA))
    vectors = Q.tag_vectors(scored, ["PHP", "Java", "Perl"], 100)
    assert sorted(tuple(r) for r in vectors.collect()) == [
        (0, 200, 4), (10, 100, 5), (11, 0, 0), (13, 0, 2)
    ]
    known = Q.tag_vectors(scored, ["PHP", "Java", "Perl"], 100, unknown="drop")
    assert sorted(r.id for r in known.collect()) == [0, 10]


@pytest.mark.parametrize("change", [{"spread": 0}, {"unknown": "guess"}, {"vocabulary": ["a", "a"]}])
def test_vector_parameters(rows, change):
    with pytest.raises(ValueError):
        Q.tag_vectors(Q.best_answer(rows(POSTINGS, SCHEMA)), **change)


def hot(spark, n=30_000):
    """A third of all answers belong to one question, a third of them have one id."""
    asked = spark.range(100).selectExpr(
        "1 posting_type", "cast(id AS int) id", "cast(NULL AS int) accepted_answer",
        "cast(NULL AS int) parent_id", "0 score", "'Java' tags",
    )
    replied = spark.range(n).selectExpr(
        "2", "cast(id AS int)", "cast(NULL AS int)",
        "cast(CASE WHEN id % 3 = 0 THEN 7 ELSE id % 100 END AS int)", "cast(id % 50 AS int)",
        "cast(NULL AS string)",
    )
    return asked.union(replied)


def test_hot_question_is_split(spark):
    postings = hot(spark)
    grouped = Q.qa_grouped(postings, 1000)
    sizes = [(r.qid, r.n) for r in grouped.select("qid", F.size("pairs").alias("n")).collect()]
    assert sum(n for _, n in sizes) == 30_000
    assert sum(1 for qid, _ in sizes if qid == 7) >= 10
    assert max(n for _, n in sizes) < 1300
    assert Q.qa_pairs(postings, 1000).count() == 30_000


def test_copies_of_one_answer_are_split(spark):
    asked = spark.range(1).selectExpr(
        "1 posting_type", "7 id", "cast(NULL AS int) accepted_answer",
        "cast(NULL AS int) parent_id", "0 score", "'Java' tags",
    )
    copies = spark.range(0, 16_000, 1, 64).selectExpr(
        "2", "99", "cast(NULL AS int)", "7", "5", "cast(NULL AS string)"
    )
    grouped = Q.qa_grouped(asked.union(copies), 1000)
    sizes = [r.n for r in grouped.select(F.size("pairs").alias("n")).collect()]
    assert sum(sizes) == 16_000 and max(sizes) < 4000
    assert Q.qa_pairs(asked.union(copies), 1000).count() == 16_000


@pytest.mark.parametrize("lookup", [10_000, 3])
def test_many_oversized_keys(spark, monkeypatch, lookup):
    monkeypatch.setattr(skew, "MAX_LOOKUP_KEYS", lookup)
    assert Q.qa_pairs(hot(spark, 3000), 10).count() == 3000


def test_scores_are_hashed(spark):
    plan = Q.best_answer(hot(spark))._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "partial_max(score" in line]
    assert partial and all("HashAggregate" in line for line in partial)


def test_one_question_is_filtered_first(rows):
    frame = rows(POSTINGS, SCHEMA)
    for parent in (0, 10, 11, 20):
        direct = Q.with_answer_to(Q.qa_grouped(frame), parent).select("qid", "block", F.size("pairs")).collect()
        few = Q.grouped_with_answer_to(frame, parent).select("qid", "block", F.size("pairs")).collect()
        assert sorted(map(tuple, few)) == sorted(map(tuple, direct))
