"""Samples that depend on row ids and a seed only, not on partitioning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from loomtally.defaults import SAMPLE_SEED
from loomtally.functions.ordering import PRIME, seeded_order


# Rows that a task puts in order at once, and keeps of all its strata, at least and at most.
HEAP_ROWS, KEPT_ROWS = 20_000, 500_000
SALTS = 16


def fixed_sample(rows: DataFrame, size: int, key: str = "id", seed: int = SAMPLE_SEED) -> DataFrame:
    """`size` rows without replacement; each task keeps its own first `size` only."""
    return rows.orderBy(seeded_order(key, seed), key).limit(size)


def stratified_sample(
    rows: DataFrame, stratum: str, quota: int, key: str = "id", seed: str | int | None = None,
    short: str = "fail",
) -> DataFrame:
    """`quota` rows of every stratum; a smaller stratum is an error, or given whole (`short="keep"`).

    Each task keeps its own first `quota` rows of a stratum only, so even one that holds most
    rows sends that many per task, whatever the quota. Spark limits ranks up to a threshold
    itself; above it tasks keep them in bounded heaps, and what they send is reduced once more
    under `SALTS` parts of a stratum before the parts meet. The default seed is the stratum.
    """
    if short not in ("fail", "keep"):
        raise ValueError("short must be 'fail' or 'keep'")
    group = Window.partitionBy(stratum)
    seeded = rows.withColumn("_order", seeded_order(key, stratum if seed is None else seed))
    if quota > int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        parts = leading_rows(seeded, stratum, quota, key).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
        seeded = _ranked(parts, Window.partitionBy(stratum, "_salt"), quota, key).drop("_salt")
    drawn = _ranked(seeded, group, quota, key).drop("_order")
    if short == "keep":
        return drawn
    drawn = drawn.withColumn("_n", F.count("*").over(group))
    complete = F.when(F.col("_n") == quota, True).otherwise(
        F.raise_error(
            F.concat(
                F.lit(f"a stratum needs at least {quota} rows: "), F.coalesce(F.col(stratum).cast("string"), F.lit("NULL"))
            )
        ).cast("boolean")
    )
    return drawn.where(complete).drop("_n")


def _ranked(rows: DataFrame, group: Window, quota: int, key: str) -> DataFrame:
    rank = F.row_number().over(group.orderBy("_order", key))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= quota).drop("_rank")


def leading_rows(rows: DataFrame, stratum: str, quota: int, key: str) -> DataFrame:
    """At least the first `quota` rows of every stratum by `_order` and key, and few others.

    A task puts rows in order when as many have come as it keeps, so each is moved a few times
    only. If its strata together keep more than `KEPT_ROWS`, they are handed on and it begins
    anew: that sends more rows and leaves none out.
    """

    def first(table: pa.Table) -> pa.Table:
        codes = table[stratum].combine_chunks().dictionary_encode().indices.fill_null(-1)
        keys = pa.table({"s": codes, "o": table["_order"], "k": table[key]})
        order = pc.sort_indices(keys, [(c, "ascending") for c in "sok"], null_placement="at_start")
        code = codes.take(order).to_numpy()
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        rank = np.arange(len(code)) - np.repeat(starts, np.diff(np.append(starts, len(code))))
        return table.take(order.filter(pa.array(rank < quota)))

    def keep(batches) -> Iterator[pa.RecordBatch]:
        kept, waiting, size = None, [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size < max(HEAP_ROWS, 0 if kept is None else kept.num_rows):
                continue
            kept = first(pa.Table.from_batches([*([] if kept is None else kept.to_batches()), *waiting]))
            waiting, size = [], 0
            if kept.num_rows > KEPT_ROWS:
                yield from kept.to_batches()
                kept = None
        if kept is not None:
            waiting = [*kept.to_batches(), *waiting]
        if sum(batch.num_rows for batch in waiting):
            yield from first(pa.Table.from_batches(waiting)).to_batches()

    return rows.mapInArrow(keep, rows.schema)


def fraction_sample(
    rows: DataFrame, fraction: float, key: str | None = None, seed: int = SAMPLE_SEED
) -> DataFrame:
    """Each row with the given probability: by hash of an integer key, or at random.

    The hash has 31 bits, so fractions down to one in two billion are met.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be from 0 to 1")
    if key is None:
        return rows.sample(fraction=float(fraction), seed=seed)
    return rows.where(seeded_order(key, seed) < math.floor(fraction * PRIME))
