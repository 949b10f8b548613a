"""Column groups, row sums and buckets of wide survey tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from loomtally.defaults import ACTIVITY_GROUPS

MINUTES_PER_HOUR = 60


def group_of(name: str, groups: Mapping[str, Sequence[str]] = ACTIVITY_GROUPS) -> str | None:
    """Group of a column name by case-sensitive prefix, the first group that matches."""
    return next((g for g, prefixes in groups.items() if name.startswith(tuple(prefixes))), None)


def column_groups(
    names: Sequence[str], groups: Mapping[str, Sequence[str]] = ACTIVITY_GROUPS
) -> dict[str, list[str]]:
    """Column names by group, in table order; names outside every group are left out."""
    placed = {group: [] for group in groups}
    for name in names:
        group = group_of(name, groups)
        if group is not None:
            placed[group].append(name)
    return placed


def group_label(name: Column, groups: Mapping[str, Sequence[str]] = ACTIVITY_GROUPS) -> Column:
    """The same rule for column names held as data; NULL outside every group."""
    label = F.lit(None).cast("string")
    for group, prefixes in reversed(list(groups.items())):
        pattern = "^(" + "|".join(map(re.escape, prefixes)) + ")"
        label = F.when(name.rlike(pattern), group).otherwise(label)
    return label


def row_sum(names: Sequence[str]) -> Column:
    """Sum of columns within a row, NULL if any of them is.

    Halving keeps the expression log-deep: a chain of several hundred additions would
    overflow the analyser's stack.
    """
    if not names:
        raise ValueError("a row sum needs at least one column")
    if len(names) == 1:
        return F.col(f"`{names[0]}`")
    half = len(names) // 2
    return row_sum(names[:half]) + row_sum(names[half:])


def hours(names: Sequence[str]) -> Column:
    return row_sum(names) / MINUTES_PER_HOUR


def working_status(telfs: Column) -> Column:
    return F.when((telfs >= 1) & (telfs < 3), "working").otherwise("not working")


def sex(tesex: Column) -> Column:
    return F.when(tesex == 1, "male").otherwise("female")


def age_band(teage: Column) -> Column:
    """Fractions between the bands, NULL and NaN count as elder."""
    return (
        F.when((teage >= 15) & (teage <= 22), "young")
        .when((teage >= 23) & (teage <= 55), "active")
        .otherwise("elder")
    )
