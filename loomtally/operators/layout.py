"""Physical layout and positions a caller may ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loomtally.operators.durable import durable

# Ranges that positions are dealt out in; one count of each is all that meets in a task.
RANGES = 1_024


def range_layout(rows: DataFrame, partitions: int, key: str, *tie_breakers: str) -> DataFrame:
    """Range partitions by key, sorted inside.

    Tie breakers let the partitioner cut within a key that is common, so no partition
    has to hold all of its rows.
    """
    columns = [key, *tie_breakers]
    return rows.repartitionByRange(partitions, *columns).sortWithinPartitions(*columns)


def ordered_positions(rows: DataFrame, *order: str, ranges: int = RANGES, name: str = "position") -> DataFrame:
    """`rows` with a dense position from 1, by the given columns, then by all others.

    Rows are cut into ranges of that whole order, so a value that a third of them share is cut
    too; equal rows are counted first and take consecutive positions. A range adds up its own
    rows, and the sizes of the ranges before it are added to that: no task sees all rows. NULL
    comes first. Columns must be orderable; `name` must be new.
    """
    if name in rows.columns:
        raise ValueError(f"there is a column {name} already")
    columns = [*order, *(c for c in rows.columns if c not in order)]
    counted = rows.groupBy(*columns).agg(F.count("*").alias("_copies"))
    cut = durable(counted.repartitionByRange(ranges, *columns).withColumn("_range", F.spark_partition_id()))
    sizes = cut.groupBy("_range").agg(F.sum("_copies").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A range is an exchange of its own; one count of each, at most `ranges`, is broadcast.
    placed = cut.withColumn("_upto", F.sum("_copies").over(inside)).join(F.broadcast(offsets), "_range")
    last = F.col("_offset") + F.col("_upto")
    return placed.select(*rows.columns, F.explode(F.sequence(last - F.col("_copies") + 1, last)).alias(name))
