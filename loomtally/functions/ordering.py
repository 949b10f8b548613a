"""Seeded pseudo-random order that any SQL engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRIME = 2147483647


def seeded_order(key: str, seed: str | int = 0) -> Column:
    """A scrambled 31-bit number for an integer key column and a seed (number or column).

    It depends on the key and the seed alone, so a sample ordered by it is the same for
    every partitioning and after every retry. Only `%`, `*`, `+`, shift and xor are used.
    """
    seed = f"{seed}L" if isinstance(seed, int) else f"cast(`{seed}` AS bigint)"
    key = f"cast(`{key}` AS bigint)"
    folded = f"pmod({key}, {PRIME}L) + pmod({key} ^ shiftright({key}, 31), 65521)"
    first = f"(({folded} + pmod({seed}, {PRIME}L)) * 48271 % {PRIME})"
    mixed = f"((({first} ^ shiftright({first}, 13)) * 69621 + 374761393) % {PRIME})"
    return F.expr(f"(({mixed} ^ shiftright({mixed}, 16)) * 39373 + 668265263) % {PRIME}")
