"""Cleaning a corpus in five stages, each over all that the one before has kept.

Language identification, line dedup, one document of each near-duplicate group, benchmark
decontamination, byte-level BPE. Every stage takes (spark, docs, sf_dir); its result is
written to the shared folder and read again for the next one. Python workers live on from stage
to stage with the most memory they ever had, so every stage sends them texts in small batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.llm import byte_bpe, decontaminate, jaccard_join, language_id, line_dedup
from loomtally.llm.queries import vocabulary
from loomtally.llm.tables import durable, small_batches, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is decided; those without text or letter go.

    The statistics are frozen on `documents` as given, also if `docs` is a part of it.
    """
    small_batches(spark)
    return language_id.keep_identified(docs, language_id.train(table(spark, sf_dir, "documents")))


def line_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents that lose all their lines go."""
    small_batches(spark)
    return line_dedup.keep_first_lines(docs)


def joined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    small_batches(spark)
    return jaccard_join.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is met."""
    small_batches(spark)
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, digests of its ids and of the bytes they decode to."""
    small_batches(spark)
    known = vocabulary()
    return byte_bpe.digests(byte_bpe.encode(docs, known), known)


STAGES = [
    ("language_id", identified),
    ("line_dedup", line_deduped),
    ("jaccard_join", joined),
    ("decontaminate", decontaminated),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs


# No SQL can express the byte context trees, the edit distance and the merges of the BPE; the
# stages are tested against brute force.
ORACLE_SQL = None
