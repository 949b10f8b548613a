"""Survey summary per respondent and its grouped averages in three front ends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from loomtally.functions import survey as S

KEYS = ("working", "sex", "age")
MEASURES = ("primaryNeeds", "work", "other")
EMPLOYABLE_MAX = 4

ROW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in KEYS]
    + [T.StructField(name, T.DoubleType(), True) for name in MEASURES]
)


def summarize(
    rows: DataFrame, groups: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Working status, sex, age band and hours per activity group of the employable.

    `groups` maps each measure to its columns; by default the column names decide. The
    filter comes first, so it and the column choice reach a columnar scan.
    """
    groups = S.column_groups(rows.columns) if groups is None else groups
    return rows.where(F.col("telfs") <= EMPLOYABLE_MAX).select(
        S.working_status(F.col("telfs")).alias("working"),
        S.sex(F.col("tesex")).alias("sex"),
        S.age_band(F.col("teage")).alias("age"),
        *[S.hours(groups[measure]).alias(measure) for measure in MEASURES],
    )


def grouped_avg(summary: DataFrame, sort: bool = False) -> DataFrame:
    """Average hours per group, rounded half up to one decimal."""
    names = [f"avg({measure})" for measure in MEASURES]
    averaged = summary.groupBy(*KEYS).agg(*[F.avg(measure) for measure in MEASURES])
    named = averaged.toDF(*KEYS, *names)
    rounded = named.withColumns({name: F.round(F.col(f"`{name}`"), 1) for name in names})
    return rounded.orderBy(*KEYS) if sort else rounded


def grouped_avg_sql_text(relation: str) -> str:
    """The same averages as SQL text, unrounded."""
    keys = ", ".join(KEYS)
    averages = ", ".join(f"avg({measure})" for measure in MEASURES)
    return f"SELECT {keys}, {averages} FROM {relation} GROUP BY {keys}"


def grouped_avg_sql(summary: DataFrame, view: str | None = None) -> DataFrame:
    """Run the SQL form, through a named temporary view or without a global name."""
    spark = summary.sparkSession
    if view is None:
        return spark.sql(grouped_avg_sql_text("{summary}"), summary=summary)
    summary.createOrReplaceTempView(view)
    return spark.sql(grouped_avg_sql_text(view))


def typed(rows: DataFrame, schema: T.StructType = ROW_SCHEMA) -> DataFrame:
    """Columns matched to a schema by name: reordered, extras dropped, missing ones an error."""
    missing = [name for name in schema.names if name not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return rows.to(schema)


def grouped_avg_typed(rows: DataFrame) -> DataFrame:
    """Rounded averages that keep the row schema of their input."""
    averaged = rows.groupBy(*KEYS).agg(
        *[F.round(F.avg(measure), 1).alias(measure) for measure in MEASURES]
    )
    return typed(averaged)


def group_totals(rows: DataFrame) -> DataFrame:
    """`column_name`, `activity_group`, `minutes`: every grouped column with its total.

    Columns are summed before they are turned into rows, so the table is never multiplied
    by its width.
    """
    groups = S.column_groups(rows.columns)
    names = [name for placed in groups.values() for name in placed]
    totals = rows.agg(*[F.sum(F.col(f"`{name}`")).alias(name) for name in names])
    group = {name: g for g, placed in groups.items() for name in placed}
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(group[name]).alias("activity_group"),
            F.col(f"`{name}`").alias("minutes"),
        )
        for name in names
    ]
    return totals.select(F.inline(F.array(*entries)))


def unpivot_groups(rows: DataFrame, key: str) -> DataFrame:
    """Long form: one row per respondent and grouped column, without a shuffle."""
    names = [n for placed in S.column_groups(rows.columns).values() for n in placed]
    long = rows.unpivot(key, names, "column_name", "minutes")
    return long.select(
        key, "column_name", S.group_label(F.col("column_name")).alias("activity_group"), "minutes"
    )


def match_check(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer comparison: every distinct key of `left` with its row count on each side.

    `flag` is OK where `right` has the key too, else NOK. Both sides are counted per key
    before they meet, so repeated keys never multiply.
    """
    mine = left.groupBy(*keys).agg(F.count("*").alias("n_left")).alias("l")
    theirs = right.groupBy(*keys).agg(F.count("*").alias("n_right")).alias("r")
    same = reduce(
        lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    )
    return mine.join(theirs, same, "left").select(
        *[F.col(f"l.{k}").alias(k) for k in keys],
        "n_left",
        F.coalesce("n_right", F.lit(0).cast("bigint")).alias("n_right"),
        F.when(F.col("n_right").isNotNull(), "OK").otherwise("NOK").alias("flag"),
    )


def rename_and_flag(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows beside their right twin, renamed by position and flagged.

    The right side's columns carry the suffix 2 and `flag` compares the first measure.
    Copies of a row are one row here, with their number in `n`.
    """
    names = left.columns
    mine = left.groupBy(*names).agg(F.count("*").alias("n")).alias("l")
    theirs = right.distinct().alias("r")
    same = reduce(
        lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in names]
    )
    paired = mine.join(theirs, same, "left").toDF(*names, "n", *[f"{c}2" for c in names])
    first, measure = KEYS[0], MEASURES[0]
    agrees = (
        F.col(first).isNotNull()
        & F.col(f"{first}2").isNotNull()
        & (F.col(measure) == F.col(f"{measure}2"))
    )
    return paired.withColumn("flag", F.when(agrees, "OK").otherwise("NOK"))
