"""Inverted index as compressed posting lists: blocks of ids, skipped by range, intersected.

A list is cut into blocks by ranges of `span` ids. A block holds the distinct ids of one term
in one range, in order: the smallest (`lo`), the largest (`hi`), their number (`n`), how many
index entries they stand for (`mentions`), and the gaps between them as variable-length numbers
(`gaps`: seven bits a byte, low ones first, the eighth set if more follow). Ids that repeat are
counted before a block is made, so no block has more than `span` of them, however often a
key occurs.

Blocks of one range of all terms carry the same number, so terms are intersected block by
block. What can't be part of the answer is ruled out by `block`, `lo` and `hi` alone, without
reading any gaps; a stored index is sorted by term and block, so that a scan for the rest
passes over row groups and pages of others.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.functions.text import check_vocabulary
from loomtally.operators.terms import id_range, sorted_ranking

SPAN = 65_536
# Numbers of surviving blocks that travel in the plan; more are pushed as a range only.
MAX_LITERAL_BLOCKS = 1_000
ROWS_PER_FILE, ROW_GROUP_BYTES = 100_000, 1 << 20


def packed_gaps(ids: np.ndarray) -> bytes:
    """The gaps between ascending distinct ids as variable-length numbers."""
    gaps = (ids[1:].view(np.uint64) - ids[:-1].view(np.uint64)).astype(np.uint64)
    size = np.ones(len(gaps), np.int64)
    for bits in range(7, 64, 7):
        size += gaps >> np.uint64(bits) > 0
    ends = np.cumsum(size)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for at in range(int(size.max()) if len(size) else 0):
        there = size > at
        more = (size[there] > at + 1).astype(np.uint8) << 7
        out[(ends - size)[there] + at] = ((gaps[there] >> np.uint64(7 * at)) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpacked(lo: int, gaps: bytes) -> np.ndarray:
    """The ids of a block, in order."""
    data = np.frombuffer(gaps, np.uint8)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    place = np.arange(len(data)) - np.repeat(starts, ends + 1 - starts)
    parts = (data & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    widths = np.add.reduceat(parts, starts) if len(ends) else parts
    first = np.array([lo], np.int64).view(np.uint64)
    return np.cumsum(np.concatenate([first, widths]), dtype=np.uint64).view(np.int64)


def posting_lists(index: DataFrame, key: str, span: int = SPAN) -> DataFrame:
    """`term`, `block`, `lo`, `hi`, `n`, `mentions`, `gaps` of an index with integer keys.

    Entries without key are left out. Equal entries are counted map-side, so a key that
    repeats a million times moves as one row per task.
    """
    if span < 1:
        raise ValueError("a block spans at least one id")

    @F.pandas_udf("binary")
    def gaps_of(lists: pd.Series) -> pd.Series:
        return pd.Series([packed_gaps(np.asarray(ids, np.int64)) for ids in lists], dtype=object)

    entries = index.where(F.col(key).isNotNull()).select("term", F.col(key).cast("bigint").alias("id"))
    counted = entries.groupBy("term", "id").agg(F.count("*").alias("copies"))
    blocks = counted.groupBy("term", id_range("id", span).alias("block")).agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.sum("copies").alias("mentions")
    )
    return blocks.select(
        "term", "block", F.element_at("ids", 1).alias("lo"), F.element_at("ids", -1).alias("hi"),
        F.size("ids").alias("n"), "mentions", gaps_of("ids").alias("gaps"),
    )


def store(lists: DataFrame, path: str, partitions: int = 32) -> None:
    """Writes the lists sorted by term and block, in small row groups whose ranges can be skipped."""
    ordered = lists.repartitionByRange(partitions, "term", "block").sortWithinPartitions("term", "block")
    writer = ordered.write.option("maxRecordsPerFile", ROWS_PER_FILE).option("parquet.block.size", ROW_GROUP_BYTES)
    writer.parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def postings(lists: DataFrame) -> DataFrame:
    """`term`, `id`: the lists unpacked, every id once a term."""

    @F.pandas_udf("array<bigint>")
    def ids_of(lo: pd.Series, gaps: pd.Series) -> pd.Series:
        return pd.Series([unpacked(*pair) for pair in zip(lo, gaps)], dtype=object)

    return lists.select("term", F.explode(ids_of("lo", "gaps")).alias("id"))


def surviving_blocks(lists: DataFrame, terms: Sequence[str]) -> DataFrame:
    """`block`, `lo`, `hi`: where all the terms have ids, within reach of each other.

    Reads terms, block numbers and ranges only.
    """
    wanted = lists.where(F.col("term").isin(list(terms)))
    met = wanted.groupBy("block").agg(
        F.count("*").alias("met"), F.max("lo").alias("lo"), F.min("hi").alias("hi")
    )
    return met.where((F.col("met") == len(terms)) & (F.col("lo") <= F.col("hi"))).select("block", "lo", "hi")


def blocks_to_read(lists: DataFrame, terms: Sequence[str]) -> DataFrame:
    """The rows of `lists` that may hold an id of all the terms.

    The numbers of the surviving blocks, or the range they lie in if they are many, become
    filters of the scan; those of the range that did not survive fall to the join.
    """
    alive = surviving_blocks(lists, terms)
    head = [row["block"] for row in alive.select("block").limit(MAX_LITERAL_BLOCKS + 1).collect()]
    wanted = lists.where(F.col("term").isin(list(terms)))
    if len(head) <= MAX_LITERAL_BLOCKS:
        return wanted.where(F.col("block").isin(head)) if head else wanted.where(F.lit(False))
    ends = alive.agg(F.min("block").alias("first"), F.max("block").alias("last"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    near = wanted.where(F.col("block").between(ends["first"], ends["last"]) & (F.col("hi") >= ends["lo"]) & (F.col("lo") <= ends["hi"]))
    return near.join(alive.select("block"), "block", "left_semi").select(*lists.columns)


def intersect(lists: DataFrame, terms: Sequence[str]) -> DataFrame:
    """`id`: keys that all the given terms have, each once.

    At most one block of each term meets in a task, the sparsest first; blocks that share no
    range are never read, let alone unpacked.
    """
    terms = check_vocabulary(terms)

    @F.pandas_udf("array<bigint>")
    def common(groups: pd.Series) -> pd.Series:
        def one(blocks) -> np.ndarray:
            found = None
            for block in sorted(blocks, key=lambda b: b["n"]):
                ids = unpacked(block["lo"], block["gaps"])
                found = ids if found is None else np.intersect1d(found, ids, assume_unique=True)
                if not len(found):
                    break
            return found

        return pd.Series([one(blocks) for blocks in groups], dtype=object)

    grouped = blocks_to_read(lists, terms).groupBy("block").agg(F.collect_list(F.struct("lo", "n", "gaps")).alias("blocks"))
    return grouped.where(F.size("blocks") == len(terms)).select(F.explode(common("blocks")).alias("id"))


def rank_from_lists(lists: DataFrame) -> DataFrame:
    """Ranking by index entries, from the block headers alone."""
    return sorted_ranking(lists.groupBy("term").agg(F.sum("mentions").alias("n")))
