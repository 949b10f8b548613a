"""Tag coordinates and distances between integer points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from loomtally.functions.text import check_vocabulary

Point = tuple[int, int]


def tag_position(tag: Column, vocabulary: Sequence[str]) -> Column:
    """Zero-based vocabulary position of a tag; unknown and missing tags share 0."""
    terms = F.array(*[F.lit(term) for term in check_vocabulary(vocabulary)])
    return F.greatest(F.array_position(terms, tag) - 1, F.lit(0).cast("bigint"))


def sq_distance(x: Column, y: Column, to_x: Column, to_y: Column) -> Column:
    """Squared distance in double arithmetic (no root is taken)."""
    dx = x.cast("double") - to_x.cast("double")
    dy = y.cast("double") - to_y.cast("double")
    return dx * dx + dy * dy


def nearest(centers: Sequence[Point], x: str = "x", y: str = "y") -> Column:
    """Index of the closest centre; ties go to the lowest index, no centres give 0.

    One distance per centre is spelled out, as SQL text because it is rebuilt for every
    update. Unlike a lambda over an array of centres this is compiled code.
    """
    if not centers:
        return F.lit(0)
    terms = (
        f"(`{x}` - {cx}D) * (`{x}` - {cx}D) + (`{y}` - {cy}D) * (`{y}` - {cy}D)"
        for cx, cy in centers
    )
    distances = f"array({', '.join(terms)})"
    return F.expr(f"cast(array_position({distances}, array_min({distances})) - 1 as int)")


def total_shift(before: Sequence[Point], after: Sequence[Point]) -> float:
    """Summed squared distance between two equally long lists of centres (driver side)."""
    if len(before) != len(after):
        raise ValueError("both lists of centres must have the same length")
    return reduce(
        lambda total, pair: total
        + float(pair[0][0] - pair[1][0]) ** 2
        + float(pair[0][1] - pair[1][1]) ** 2,
        zip(before, after),
        0.0,
    )
