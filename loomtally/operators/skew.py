"""Finding heavy keys with a sketch, and splitting the groups and joins they make.

Each task keeps a Misra-Gries summary of its key hashes: at most `COUNTERS` counters; when
there are more, all are lowered by the largest one that has to go, and the sum of what was
taken off is kept as the summary's error. Summaries are merged by adding counters and errors.
A key's true count is at most its merged counter plus the merged error, so every key above a
limit is among those whose counter passes the limit less the error; only these are counted
exactly. No task sorts or shuffles one row per distinct key. If the error should come to half
of the limit, which takes more than `COUNTERS / 2` times the limit in rows, all are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomtally.operators.durable import durable

COUNTERS = 100_000
# Heavy keys that travel in the plan, and those broadcast from a table, at most.
MAX_LOOKUP_KEYS, MAX_BROADCAST_KEYS = 10_000, 1_000_000
# Copies of a longer look-up table; rows meet it under their key and one of these numbers.
SALTS = 64

KEY, BLOCK, BLOCKS, COPIES, HASH, SALT = "_key", "_block", "_blocks", "_copies", "_hash", "_salt"


def summary(hashes: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counters of distinct hashes, at most as many as stated, and what each may lack."""
    known, place = np.unique(hashes, return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, place.reshape(-1), counts)
    if len(known) <= counters:
        return known, total, 0
    lowered = int(np.partition(total, len(total) - counters - 1)[len(total) - counters - 1])
    return known[total > lowered], total[total > lowered] - lowered, lowered


def summaries(hashes: DataFrame, counters: int) -> DataFrame:
    """`_hash`, `n`: the counters of each partition, and its error under a NULL hash."""

    def count(batches):
        known, total, missed = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            fresh = batch[HASH].to_numpy(zero_copy_only=False)
            ones = np.ones(len(fresh), np.int64)
            known, total, lowered = summary(np.concatenate([known, fresh]), np.concatenate([total, ones]), counters)
            missed += lowered
        found = pa.concat_arrays([pa.array(known, pa.int64()), pa.array([None], pa.int64())])
        yield pa.RecordBatch.from_arrays([found, pa.array(np.append(total, missed))], names=[HASH, "n"])

    return hashes.mapInArrow(count, f"{HASH} long, n long")


@dataclass(frozen=True)
class Oversized:
    """`_key` and number of blocks of heavy keys; `small` if the table's size allows a broadcast."""

    keys: DataFrame
    small: bool


def heavy_candidates(rows: DataFrame, key: Column, limit: int) -> list[int] | DataFrame | None:
    """Hashes among which those of all keys with more than `limit` rows are; None if it can't say.

    A list of up to `MAX_LOOKUP_KEYS`, or a stored table (`_hash`) of up to `MAX_BROADCAST_KEYS`.
    """
    merged = summaries(rows.select(F.xxhash64(key).alias(HASH)), COUNTERS).groupBy(HASH).agg(F.sum("n").alias("n"))
    passing = merged.where(F.col(HASH).isNull() | (F.col("n") > limit - limit // 2))
    # The error comes first, then the largest counters; each task hands over its first rows only.
    head = passing.orderBy(F.col(HASH).isNotNull(), F.desc("n")).limit(MAX_LOOKUP_KEYS + 2).collect()
    if head and head[0]["n"] > limit // 2:
        return None
    if len(head) <= MAX_LOOKUP_KEYS + 1:
        return [row[HASH] for row in head[1:]]
    table = durable(passing.where(F.col(HASH).isNotNull()).select(HASH))
    return table if table.count() <= MAX_BROADCAST_KEYS else None


def oversized_keys(rows: DataFrame, key: Column, limit: int) -> Oversized | None:
    """Keys with more than `limit` rows and their number of blocks; None without any.

    Only the key column is read. The usual case, no heavy key, ends with the sketch. Else the
    candidates are counted exactly, map-side first.
    """
    candidates = heavy_candidates(rows, key, limit)
    if isinstance(candidates, list):
        if not candidates:
            return None
        wanted = rows.where(F.xxhash64(key).isin(candidates))
    elif candidates is not None:
        hashed = rows.withColumn(HASH, F.xxhash64(key))
        wanted = hashed.join(F.broadcast(candidates), HASH, "left_semi")
    else:
        wanted = rows
    sizes = (
        wanted.groupBy(key.alias(KEY))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > limit)
        .select(KEY, F.ceil(F.col("n") / limit).cast("int").alias(BLOCKS))
    )
    head = sizes.orderBy(F.desc(BLOCKS)).limit(MAX_LOOKUP_KEYS + 1).collect()
    if not head:
        return None
    if len(head) <= MAX_LOOKUP_KEYS:
        return Oversized(rows.sparkSession.createDataFrame(head, sizes.schema), True)
    table = durable(sizes)
    return Oversized(table, table.count() <= MAX_BROADCAST_KEYS)


def marked(rows: DataFrame, key: Column, oversized: Oversized) -> DataFrame:
    """Adds `_blocks`, NULL for ordinary keys; no row is shuffled by a heavy key alone."""
    keys = oversized.keys
    if oversized.small:
        return rows.join(F.broadcast(keys), key.eqNullSafe(keys[KEY]), "left").drop(KEY)
    copies = keys.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Equal rows of different partitions get different salts.
    salt = F.pmod(F.xxhash64(*rows.columns) + F.spark_partition_id(), F.lit(SALTS)).cast("int")
    salted = rows.withColumn(SALT, salt)
    met = key.eqNullSafe(copies[KEY]) & (F.col(SALT) == copies["_copy"])
    return salted.join(copies, met, "left").drop(KEY, SALT, "_copy")


def with_blocks(rows: DataFrame, key: Column, oversized: Oversized | None) -> DataFrame:
    """Adds `_block`: 0 for ordinary keys, a hash of row and copy number for oversized ones.

    Exact copies of a row are counted map-side and numbered, so they are spread too and the
    blocks depend on the rows alone, not on how they are partitioned.
    """
    if oversized is None:
        return rows.withColumn(BLOCK, F.lit(0))
    joined = marked(rows, key, oversized)
    ordinary = joined.where(F.col(BLOCKS).isNull()).select(*rows.columns, F.lit(0).alias(BLOCK))
    counted = joined.where(F.col(BLOCKS).isNotNull()).groupBy(*rows.columns, BLOCKS).agg(F.count("*").alias(COPIES))
    copies = counted.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(COPIES))))
    block = F.pmod(F.xxhash64(*rows.columns, COPIES), F.col(BLOCKS)).cast("int")
    return ordinary.unionByName(copies.select(*rows.columns, block.alias(BLOCK)))


def for_every_block(rows: DataFrame, key: Column, oversized: Oversized | None) -> DataFrame:
    """The other join side: one copy per block of its key, a single one for ordinary keys."""
    if oversized is None:
        return rows.withColumn(BLOCK, F.lit(0))
    joined = marked(rows, key, oversized)
    last = F.coalesce(F.col(BLOCKS) - 1, F.lit(0))
    return joined.withColumn(BLOCK, F.explode(F.sequence(F.lit(0), last))).drop(BLOCKS)
