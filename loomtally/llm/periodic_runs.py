"""Maximal periodic runs of words: grammar extensions from a harmonic grid.

Method. The words of a batch of texts, numbered, form one string in which a symbol of its own
stands before, between and behind the texts. Recompression turns it into a run-length grammar:
in turn, blocks of equal symbols become one symbol, and pairs of a left and a right symbol (a
hash bit of the symbol says which) become one, until each text is a single symbol. The rules
look at neighbours only, so equal stretches are cut alike, and the longest common extension of
two places is found by climbing while the symbols agree and descending where they differ; a
block is skipped as a whole, so no query walks through it word by word.

A run of period `p` holds at least `max(min_words, exponent * p) - p` consecutive words equal
to the word `p` on, so a grid of that step meets it. Grid points whose words agree are extended
both ways; this gives the run exactly. Points of one run, also those of multiples of its
period, give equal ends, of which the smallest period stays. Summed over all periods the grid
has `n log n` points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomtally.llm.words import mixed, slices

MIN_WORDS = 24
EXPONENT = 3
# Grid points looked at in one go.
POINTS = 1_000_000


class _Level:
    """A string and how its symbols make up those of the next one."""

    def __init__(self, symbols: np.ndarray, head: np.ndarray, blocks: bool) -> None:
        self.symbols, self.head = symbols, head
        self.parent = np.cumsum(head) - 1
        self.first = np.flatnonzero(head)
        self.left = np.append(self.first[1:], len(head))[self.parent] - np.arange(len(head)) if blocks else None

    def step(self, x: np.ndarray, y: np.ndarray) -> np.ndarray | int:
        """Symbols that are surely equal from two places with equal symbols."""
        return 1 if self.left is None else np.minimum(self.left[x], self.left[y])

    def mirrored(self) -> _Level:
        last = np.append(self.head[1:], True)
        return _Level(self.symbols[::-1], last[::-1], self.left is not None)


def _named(keys: np.ndarray, start: int) -> tuple[np.ndarray, int]:
    """Equal keys get equal numbers from `start` on; also the next free number."""
    distinct, names = np.unique(keys, return_inverse=True)
    return names.reshape(-1) + start, start + len(distinct)


def grammar(string: np.ndarray, words: int, texts: int) -> list[_Level]:
    """Levels up to one symbol a text; symbols from `words` on separate texts, each used once."""
    levels, symbols, free = [], string, words + texts + 1
    turn = 0
    while len(symbols) > 2 * texts + 1:
        head = np.append(True, symbols[1:] != symbols[:-1])
        if not head.all():
            levels.append(_Level(symbols, head, True))
            size = np.diff(np.append(levels[-1].first, len(symbols)))
            symbols = symbols[head]
            long = np.flatnonzero(size > 1)
            symbols[long], free = _named(symbols[long] * (len(string) + 1) + size[long], free)
        turn += 1
        right = (mixed(symbols.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1)).astype(bool)
        inner = (symbols < words) | (symbols > words + texts)
        pair = np.flatnonzero((~right & inner)[:-1] & (right & inner)[1:])
        if len(pair):
            head = np.ones(len(symbols), bool)
            head[pair + 1] = False
            levels.append(_Level(symbols, head, False))
            names, free = _named(symbols[pair] * (1 << 31) + symbols[pair + 1], free)
            symbols = symbols.copy()
            symbols[pair] = names
            symbols = symbols[head]
    return levels


def extensions(levels: list[_Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols agree from `i` and `j` on, different places of one text each."""
    x, y, who, stopped = i, j, np.arange(len(i)), []
    for level in levels:
        risen, differing = [], []
        while len(who):
            same = level.symbols[x] == level.symbols[y]
            differing.append((x[~same], y[~same], who[~same]))
            up = same & level.head[x] & level.head[y]
            risen.append((level.parent[x[up]], level.parent[y[up]], who[up]))
            on = same & ~up
            x, y, who = x[on], y[on], who[on]
            step = level.step(x, y)
            x, y = x + step, y + step
        stopped.append([np.concatenate(c) for c in zip(*differing)] or [i[:0]] * 3)
        x, y, who = [np.concatenate(c) for c in zip(*risen)] or [i[:0]] * 3
    found = np.zeros(len(i), np.int64)
    x, y, who = i[:0], i[:0], i[:0]
    for level, ends in zip(reversed(levels), reversed(stopped)):
        x, y = level.first[x], level.first[y]
        while len(same := np.flatnonzero(level.symbols[x] == level.symbols[y])):
            step = level.step(x[same], y[same])
            x[same] += step
            y[same] += step
        x, y, who = [np.concatenate(c) for c in zip((x, y, who), ends)]
    found[who] = x - i[who]
    return found


def _grid(lengths: np.ndarray, ends: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods; texts come longest first, so those a period fits in are a prefix."""
    periods = np.arange(1, (lengths[0] if len(lengths) else 0) // exponent + 1)
    fitting = np.searchsorted(-lengths, -np.maximum(least, exponent * periods), side="right")
    periods, fitting = periods[fitting > 0], fitting[fitting > 0]
    steps = np.maximum(least, exponent * periods) - periods
    counts = -(-ends[fitting - 1] // steps)
    done = 0
    while done < len(periods):
        # Periods whose points fit; those of a single period are cut further.
        upto = max(done + 1, int(np.searchsorted(np.cumsum(counts[done:]), POINTS, side="right")) + done)
        for low in range(0, int(counts[done]) if upto == done + 1 else 1, POINTS):
            number = np.minimum(counts[done:upto] - low, POINTS) if upto == done + 1 else counts[done:upto]
            before = np.cumsum(number) - number
            at = np.arange(number.sum()) - np.repeat(before, number) + low
            yield at * np.repeat(steps[done:upto], number), np.repeat(periods[done:upto], number)
        done = upto


def _least_periods(rows: np.ndarray) -> np.ndarray:
    """One row (start, end, period) for each start and end."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]]


def runs_of(texts: list[list[bytes]], least: int = MIN_WORDS, exponent: int = EXPONENT) -> list[np.ndarray]:
    """Per text the rows (start, length, period) of its runs, by start, then period."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    order = sorted((t for t in range(len(texts)) if len(texts[t]) >= least), key=lambda t: -len(texts[t]))
    if not order:
        return out
    numbers: dict[bytes, int] = {}
    numbered = [np.array([numbers.setdefault(w, len(numbers)) for w in texts[t]], np.int64) for t in order]
    lengths = np.array([len(n) for n in numbered])
    words, parts = len(numbers), []
    for at, number in enumerate(numbered):
        parts += [[words + at], number]
    string = np.concatenate([*parts, [words + len(order)]])
    owner = np.repeat(np.arange(len(order) + 1), np.append(lengths + 1, 1))
    ends = np.cumsum(lengths + 1)
    levels = grammar(string, words, len(order))
    mirror, last = [level.mirrored() for level in levels], len(string) - 1
    found = [np.zeros((0, 3), np.int64)]
    for i, period in _grid(lengths, ends, least, exponent):
        inside = i + period <= last
        i, period = i[inside], period[inside]
        hit = (string[i] == string[i + period]) & (owner[i] == owner[i + period])
        i, period = i[hit], period[hit]
        if not len(i):
            continue
        onward = extensions(levels, i, i + period)
        back = extensions(mirror, last - i, last - i - period) - 1
        start, end = i - back, i + onward + period
        long = end - start >= np.maximum(least, exponent * period)
        found.append(_least_periods(np.stack([start[long], end[long], period[long]], 1)))
    rows = _least_periods(np.concatenate(found))
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    first = ends - lengths
    cuts = np.searchsorted(rows[:, 0], np.append(first, last))
    for at, t in enumerate(order):
        start, end, period = rows[cuts[at] : cuts[at + 1]].T
        out[t] = np.stack([start - first[at], end - start, period], 1)
    return out


def _kept(words: list[bytes], runs: np.ndarray) -> str:
    """The words that no run holds after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def periodic_runs(docs: DataFrame, least: int = MIN_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """`doc_id`, `runs` and `collapsed` for every row of `docs`.

    `runs` is an array of (`start`, `length`, `period`) by start, then period: stretches of
    words with that smallest period, of at least `least` words and `exponent` periods, that no
    neighbouring word extends. `collapsed` is the text's words, joined by one space, without
    those that a run holds after its first period.

    Words end at ASCII white space and are compared byte for byte. A NULL, empty or blank text
    has no run and collapses to an empty string. Rows are looked at one by one: repeated rows
    and ids, also NULL ids, each give their own result. Other columns of `docs`, whatever their
    names, are left out. A text is worked on in one task, in memory in proportion to its words.
    """
    if least < 1 or exponent < 2:
        raise ValueError("a run has at least one word and two periods")

    def scan(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            for part in slices(texts):
                words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts[part]]
                runs = runs_of(words, least, exponent)
                bounds = np.cumsum([0, *(len(r) for r in runs)])
                flat = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
                columns = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat[:, c])) for c in range(3)]
                collapsed = pa.array([_kept(w, r) for w, r in zip(words, runs)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][part.start : part.stop], *columns, collapsed],
                    names=["doc_id", "start", "length", "period", "collapsed"],
                )

    found = docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start array<long>, length array<long>,"
        " period array<long>, collapsed string",
    )
    return found.select("doc_id", F.arrays_zip("start", "length", "period").alias("runs"), "collapsed")


def digests(found: DataFrame) -> DataFrame:
    """Per row the number of runs, the one of greatest length in periods, and digests."""
    ahead = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)), lambda best, run: F.when(ahead(best, run), run).otherwise(best)
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`, every tenth text (by a checksum of its id) made periodic from a word on."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    drawn = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    cut = drawn.select("doc_id", "text", F.when(F.col("h") % 10 == 0, words).alias("words"), F.expr("h div 10").alias("g"))
    n: Column = F.size("words")
    placed = cut.select("*", F.when(n > 0, F.pmod("g", n)).cast("int").alias("a"), n.alias("n"))
    tail = F.col("n") - F.col("a")
    sized = placed.select("*", (1 + F.floor(tail / (3 + F.col("g") % 8))).cast("int").alias("p"))
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil(tail / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), tail)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return sized.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))
