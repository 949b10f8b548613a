"""Exact median per group, without holding a group in one task."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loomtally.operators.durable import durable

# A 32-bit value splits into at most this many ranges of at most this many values.
RANGE = 65536


def group_median(
    rows: DataFrame, group: str, value: str, weight: Column | None = None
) -> DataFrame:
    """`group`, `n`, `median`; the mean of two middle values truncates toward zero.

    Equal values are counted first. Running counts over value ranges find the ranges that
    hold the middle positions, and running counts over the values of just those ranges
    find the middle values. Both windows see at most 65,536 rows per partition.
    """
    if not isinstance(rows.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        raise ValueError("the median needs 32-bit integer values")
    counted = (
        rows.where(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("g"), F.col(value).cast("bigint").alias("v"))
        .agg((F.count("*") if weight is None else F.sum(weight)).alias("w"))
        .where("w > 0")
        .withColumn("r", F.shiftright("v", 16))
    )
    whole = Window.partitionBy("g")
    running = whole.orderBy("r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        counted.groupBy("g", "r")
        .agg(F.sum("w").alias("w"))
        .select(
            F.col("g").alias("rg"),
            F.col("r").alias("rr"),
            F.sum("w").over(whole).alias("n"),
            F.sum("w").over(running).alias("upto"),
            (F.sum("w").over(running) - F.col("w")).alias("before"),
        )
        .where(_covers_middle("before", "upto"))
    )
    within = Window.partitionBy("g", "r").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        # Null-safe on both keys: a plain equality would add a filter to one side only, and
        # the count of values could then not be shared between the two.
        counted.join(
            ranges,
            F.col("g").eqNullSafe(F.col("rg")) & F.col("r").eqNullSafe(F.col("rr")),
        )
        .withColumn("upto", F.col("before") + F.sum("w").over(within))
        .where(_covers_middle(F.col("upto") - F.col("w"), "upto"))
        .groupBy("g", "n")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"))
        .select(
            F.col("g").alias(group),
            "n",
            F.expr("cast((low + high) div 2 as int)").alias("median"),
        )
    )


def _covers_middle(before: Column | str, upto: Column | str) -> Column:
    """Positions `before + 1` to `upto` include a middle one of `n`."""
    before = F.col(before) if isinstance(before, str) else before
    upto = F.col(upto) if isinstance(upto, str) else upto
    lower, upper = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    return (before < upper) & (lower <= upto)


# --- wide values ---------------------------------------------------------------------

# Bits that are still open after each pass over the rows around the middle.
SHIFTS = (48, 32, 16, 0)
TOP_BITS = 0x7FFF_FFFF_FFFF_FFFF
NAN_BITS = int(np.array(np.nan).view(np.int64))
MAX_BROADCAST_RANGES, MAX_DIGITS = 1_000_000, 15


@F.pandas_udf(T.LongType())
def _ordered_bits(values: pd.Series) -> pd.Series:
    """Doubles as 64-bit integers in the same order; NaN is the largest, both zeros are one."""
    numbers = values.to_numpy(np.float64, na_value=np.nan) + 0.0
    bits = np.where(np.isnan(numbers), np.nan, numbers).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ TOP_BITS, bits))


@F.pandas_udf(T.DoubleType())
def _from_bits(values: pd.Series) -> pd.Series:
    bits = values.to_numpy(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ TOP_BITS, bits).view(np.float64))


def _integers(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _ordered_bits(value.cast("double"))
    if isinstance(kind, T.DecimalType) and kind.precision <= MAX_DIGITS:
        return (value * F.lit(10**kind.scale).cast(T.DecimalType(kind.scale + 1, 0))).cast("bigint")
    raise ValueError(f"no median of values of type {kind.simpleString()}")


def _middle(low: str, high: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # NaN would come back from Arrow as NULL; it is the largest, so it is found on the high side.
        mean = (_from_bits(F.col(low)) + _from_bits(F.col(high))) / 2
        return F.when(F.col(high) == NAN_BITS, F.lit(float("nan"))).otherwise(mean)
    both = f"cast({low} as decimal(20,0)) + cast({high} as decimal(20,0))"
    if isinstance(kind, T.IntegralType):
        return F.expr(f"cast(({both}) div 2 as bigint)")
    places = kind.scale + 1
    unit = F.lit(Decimal(1).scaleb(-places)).cast(T.DecimalType(places, places))
    return (F.expr(f"cast(({both}) * 5 as decimal(17,0))") * unit).cast(T.DecimalType(kind.precision + 2, places))


def group_median_wide(rows: DataFrame, group: str, value: str, weight: Column | None = None) -> DataFrame:
    """`group`, `n`, `median` over integers of up to 64 bits, doubles and decimals of up to 15 digits.

    Values are taken as 64-bit integers in the same order and worked on 16 bits at a time:
    running counts over at most 65,536 ranges of a group find those with a middle position, and
    only rows in these, of which there are two at most, come to the next pass. Rows in the middle
    ranges of the first pass are stored, so the input is read twice. No task holds a group.

    NULL values, and rows without weight, are left out; a group that has no other has no row. The
    mean of two middle values truncates toward zero for integers and is exact for decimals; NaN is
    the largest double.
    """
    kind = rows.schema[value].dataType
    ones = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    source = (
        rows.where(F.col(value).isNotNull())
        .select(F.col(group).alias("g"), _integers(F.col(value), kind).alias("v"), ones.alias("w"))
        .where("w > 0")
    )
    rest, ranges = source, None
    for at, shift in enumerate(SHIFTS):
        part = F.shiftright("v", shift).alias("p")
        if ranges is None:
            sizes = source.groupBy("g", part).agg(F.sum("w").alias("w"))
            whole = Window.partitionBy("g")
            sizes = sizes.withColumn("n", F.sum("w").over(whole)).withColumn("before", F.lit(0).cast("bigint"))
            inside = whole.orderBy("p")
        else:
            few = durable(ranges)
            wanted = few.select(F.col("g").alias("rg"), F.col("p").alias("rp"), "n", "before")
            if few.count() <= MAX_BROADCAST_RANGES:
                wanted = F.broadcast(wanted)
            met = F.col("g").eqNullSafe(F.col("rg")) & (F.shiftright("v", SHIFTS[at - 1]) == F.col("rp"))
            rest = rest.join(wanted, met).select("g", "v", "w", "rp", "n", "before")
            rest = durable(rest) if at == 1 else rest
            sizes = rest.groupBy("g", "rp", "n", "before", part).agg(F.sum("w").alias("w"))
            inside = Window.partitionBy("g", "rp").orderBy("p")
            rest = rest.select("g", "v", "w")
        running = F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counted = sizes.withColumn("upto", F.col("before") + running)
        ranges = counted.where(_covers_middle(F.col("upto") - F.col("w"), "upto")).select(
            "g", "p", "n", (F.col("upto") - F.col("w")).alias("before")
        )
    found = ranges.groupBy("g", "n").agg(F.min("p").alias("low"), F.max("p").alias("high"))
    return found.select(F.col("g").alias(group), "n", _middle("low", "high", kind).alias("median"))
