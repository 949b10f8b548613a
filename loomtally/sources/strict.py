"""Fail-fast and drop modes shared by the readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MODES = ("fail", "drop")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def keep_valid(rows: DataFrame, valid: Column, message: Column, mode: str) -> DataFrame:
    """Rows that are valid; others raise (`fail`) or are left out (`drop`).

    The check is a filter on the rows themselves, so column pruning cannot skip it.
    """
    check_mode(mode)
    valid = F.coalesce(valid, F.lit(False))
    if mode == "drop":
        return rows.where(valid)
    return rows.where(F.when(valid, True).otherwise(F.raise_error(message).cast("boolean")))
