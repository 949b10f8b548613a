"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel distance.

Texts and items are compared in lower case with every run of white space as one space. An
item of m characters may be met with up to `error_percent` of m edits (rounded down). Cut
into one piece more than that, it leaves at least one piece untouched wherever it occurs, so
exact piece hits (one automaton for all pieces) find every place to verify. A place is the
item's extent around the hit, widened by the error budget; overlapping places of an item are
verified together, by the smallest edit distance of the item to any substring.

The item table is cut into blocks of bounded size, each of which travels to the tasks and
meets all rows. Nothing is shuffled but the matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F

from loomtally.llm.tables import fresh, rows_key, shipped

ERROR_PERCENT = 5
# Characters of items in one block; the automaton of a block takes some 100 bytes for each.
BLOCK_CHARS = 500_000


def normalised(text: str | None) -> str:
    return "" if text is None else " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """`budget + 1` pieces of nearly equal length with their offsets; none is empty."""
    count = min(budget + 1, len(item))
    cuts = [k * len(item) // count for k in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(item: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of the item to a substring of the text, and its first end."""
    m = len(item)
    masks: dict[str, int] = defaultdict(int)
    for k, char in enumerate(item):
        masks[char] |= 1 << k
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, char in enumerate(text, 1):
        eq = masks.get(char, 0)
        zero = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up = minus | (~(zero | plus) & full)
        down = plus & zero
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (~(zero | up) & full)
        minus = up & zero
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Pieces of a block of items; the automaton is built once per Python worker."""

    def __init__(self, items: list[tuple[int, str]], error_percent: int) -> None:
        self.items, self.error_percent, self.automaton = items, error_percent, None

    def __getstate__(self):
        return self.items, self.error_percent

    def __setstate__(self, state):
        self.items, self.error_percent = state
        self.automaton = None

    def build(self) -> None:
        import ahocorasick

        found: dict[str, list] = defaultdict(list)
        self.budgets = [len(text) * self.error_percent // 100 for _, text in self.items]
        for k, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text, self.budgets[k]):
                found[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.any = bool(found)

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text) of every item met, best place."""
        if self.automaton is None:
            self.build()
        read = normalised(text)
        if not self.any or not read:
            return []
        places: dict[int, list] = defaultdict(list)
        for last, (length, owners) in self.automaton.iter(read):
            for k, offset in owners:
                start, budget = last + 1 - length - offset, self.budgets[k]
                at = (max(0, start - budget), min(len(read), start + len(self.items[k][1]) + budget))
                own = places[k]
                if own and at[0] <= own[-1][1]:
                    own[-1] = (min(own[-1][0], at[0]), max(own[-1][1], at[1]))
                else:
                    own.append(at)
        out = []
        for k, spans in places.items():
            identity, item = self.items[k]
            distance, end = min((d, a + e) for a, b in spans for d, e in [best_distance(item, read[a:b])])
            if distance <= self.budgets[k]:
                out.append((identity, distance, end))
        return out


def _blocks(benchmark: DataFrame, error_percent: int, block_chars: int) -> Iterator[Matcher]:
    """Matchers over consecutive items, of about `block_chars` characters each."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    block: list[tuple[int, str]] = []
    size = 0
    for row in items.toLocalIterator():
        text = normalised(row["text"])
        if text:
            block.append((row["item_id"], text))
            size += len(text)
        if size >= block_chars:
            yield Matcher(block, error_percent)
            block, size = [], 0
    if block:
        yield Matcher(block, error_percent)


def _matching(shared):
    @F.pandas_udf("array<struct<item_id long, distance int, end int>>")
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [[Row(item_id=i, distance=d, end=e) for i, d, e in shared.value.matches(t)] for t in batch],
                dtype=object,
            )

    return matched


def contaminated(
    docs: DataFrame, benchmark: DataFrame, error_percent: int = ERROR_PERCENT, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """`node`, `doc_id`, `item_id`, `distance`, `end` for every item met in a document.

    `end` is where the best (then first) place ends in the normalised text. NULL or empty
    texts and items match nothing; items without id are left out; an id with several texts
    is met if any of them is, with the smallest distance. Repeated documents give repeated
    rows. Other columns are not looked at.
    """
    if not 0 <= error_percent < 100:
        raise ValueError("error_percent must be from 0 to 99")
    texts = docs.select(rows_key(docs).alias("node"), "doc_id", "text")
    found = None
    for matcher in _blocks(benchmark, error_percent, block_chars):
        matched = _matching(shipped(docs.sparkSession, matcher))
        part = texts.select("node", "doc_id", F.explode(matched("text")).alias("m")).select("node", "doc_id", "m.*")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.where(F.lit(False)).selectExpr("node", "doc_id", "0L AS item_id", "0 AS distance", "0 AS end")
    return found


def report(docs: DataFrame, benchmark: DataFrame, error_percent: int = ERROR_PERCENT) -> DataFrame:
    """`doc_id`, `item_id`, `distance`: one row per contaminated document and item."""
    return (
        contaminated(docs, benchmark, error_percent)
        .groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, error_percent: int = ERROR_PERCENT) -> DataFrame:
    """Rows of `docs`, with all their columns, in which no item is met."""
    name = fresh(docs, "_llm_node")
    gone = contaminated(docs, benchmark, error_percent).select(F.col("node").alias(name)).distinct()
    return docs.withColumn(name, rows_key(docs)).join(gone, name, "left_anti").select(*docs.columns)
