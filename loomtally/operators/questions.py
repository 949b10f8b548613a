"""Pairing questions with answers, scoring questions and placing them as points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomtally.defaults import PROGRAMMING_LANGUAGES, TAG_SPREAD
from loomtally.functions.points import tag_position
from loomtally.operators.skew import BLOCK, for_every_block, oversized_keys, with_blocks
from loomtally.sources.postings import ANSWER, COLUMNS, QUESTION

# Rows of one question a single task should see at most.
ROWS_PER_TASK = 5_000_000
PAIRS_PER_BLOCK = 50_000


def is_question() -> Column:
    return F.col("posting_type") == QUESTION


def is_answer() -> Column:
    return F.col("posting_type") == ANSWER


def answered_id(parent_id: Column) -> Column:
    """Question an answer belongs to; answers without parent belong to question 0."""
    return F.coalesce(parent_id, F.lit(0))


def questions(postings: DataFrame) -> DataFrame:
    return postings.where(is_question())


def answers(postings: DataFrame) -> DataFrame:
    return postings.where(is_answer())


def _blocked_pairs(postings: DataFrame, rows_per_block: int) -> DataFrame:
    """Pairs as `question` and `answer` structs with `qid` and the answer's `_block`."""
    replies = answers(postings).withColumn("qid", answered_id(F.col("parent_id")))
    oversized = oversized_keys(replies, F.col("qid"), rows_per_block)
    right = with_blocks(replies, F.col("qid"), oversized).select(
        "qid", BLOCK, F.struct(*COLUMNS).alias("answer")
    )
    left = for_every_block(questions(postings), F.col("id"), oversized).select(
        F.col("id").alias("qid"), BLOCK, F.struct(*COLUMNS).alias("question")
    )
    return left.join(right, ["qid", BLOCK])


def qa_pairs(postings: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every question with each of its answers: `qid`, `question`, `answer`.

    Questions without answers and answers without question drop out; duplicates multiply.
    Answers to a question that has more than `rows_per_task` of them are spread over
    several join keys, with the question copied to each.
    """
    return _blocked_pairs(postings, rows_per_task).drop(BLOCK)


def qa_grouped(postings: DataFrame, pairs_per_block: int = PAIRS_PER_BLOCK) -> DataFrame:
    """Nested pairs per question: `qid`, `block`, `pairs`.

    A question with up to `pairs_per_block` answers has one block. A larger one is cut
    into blocks of about that size by a hash, so no array holds an unbounded group.
    """
    return (
        _blocked_pairs(postings, pairs_per_block)
        .groupBy("qid", F.col(BLOCK).alias("block"))
        .agg(F.collect_list(F.struct("question", "answer")).alias("pairs"))
    )


def with_answer_to(grouped: DataFrame, parent_id: int) -> DataFrame:
    """Blocks where any pair's answer belongs to the given question.

    Such a block carries that id as its own `qid`; saying so lets the filter reach the scans.
    """
    belongs = F.exists(
        "pairs", lambda pair: answered_id(pair["answer"]["parent_id"]) == parent_id
    )
    return grouped.where((F.col("qid") == parent_id) & belongs)


def grouped_with_answer_to(
    postings: DataFrame, parent_id: int, pairs_per_block: int = PAIRS_PER_BLOCK
) -> DataFrame:
    """The blocks of `qa_grouped` for one question, from the postings that can be in them.

    Both scans are filtered by id before anything is counted or joined.
    """
    belongs = answered_id(F.col("parent_id")) == parent_id
    exact = F.col("parent_id") == parent_id
    wanted = exact | F.col("parent_id").isNull() if parent_id == 0 else exact
    few = postings.where((is_question() & (F.col("id") == parent_id)) | (is_answer() & wanted & belongs))
    return with_answer_to(qa_grouped(few, pairs_per_block), parent_id)


def best_answer(postings: DataFrame) -> DataFrame:
    """Each answered question with its best answer score, never below 0.

    Scores are reduced to their maximum per question over integers alone, map-side first,
    so answers are hashed and never sorted before the exchange; a question with very many
    answers sends one row per map task. The choice among duplicate ids (the smallest
    remaining columns) reads the questions only. The two reduced sides then meet.
    """
    others = [c for c in COLUMNS if c != "id"]
    asked = questions(postings).groupBy("id").agg(F.min(F.struct(*others)).alias("question"))
    best = (
        answers(postings).groupBy(answered_id(F.col("parent_id")).alias("qid"))
        .agg(F.max("score").alias("best"))
    )
    return asked.join(best, F.col("id") == F.col("qid")).select(
        *["id" if c == "id" else F.col(f"question.{c}").alias(c) for c in COLUMNS],
        F.greatest(F.lit(0), F.col("best")).alias("high_score"),
    )


def tag_vectors(
    scored: DataFrame,
    vocabulary: Sequence[str] = PROGRAMMING_LANGUAGES,
    spread: int = TAG_SPREAD,
    unknown: str = "first",
) -> DataFrame:
    """Points `x` (vocabulary position of the tag times spread) and `y` (best score).

    Unknown and missing tags count as the first term, or are left out with
    `unknown="drop"`.
    """
    if spread <= 0:
        raise ValueError("spread must be positive: the tag is recovered from x")
    if unknown not in ("first", "drop"):
        raise ValueError("unknown must be 'first' or 'drop'")
    if unknown == "drop":
        scored = scored.where(F.col("tags").isin(list(vocabulary)))
    x = tag_position(F.col("tags"), vocabulary).cast("int") * F.lit(spread)
    return scored.select("id", x.alias("x"), F.col("high_score").alias("y"))
