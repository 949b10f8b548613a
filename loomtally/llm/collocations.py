"""Phrase collocations per language, from stripes.

Method. A stripe belongs to a prefix of words and counts the words that come next. Each task
builds the stripes of a bounded run of texts at once and hands on one row per prefix with its
next words and their counts; stripes of a prefix are then merged elementwise, in sorted order,
so that only one is in memory. One structure gives everything: an element is the frequency of
prefix and next word, the sum over the empty prefix's stripe is the number of words, and the
largest element tells how often the commonest longer phrase occurs, which may subsume the prefix.

Prefixes of 0, 1, 2, ... words are counted one after the other. A phrase is only counted where
the two phrases one word shorter that it holds are frequent, since it can't be more frequent
than they are. They are looked up in a bitmap, which may let others through but holds back none;
its size follows their number up to `MAX_BITS`, beyond which it saves less and is as right. A
prefix has one row per shard and run of texts, however common it is. The stripe of a prefix that
occurs `SPLIT_FROM` times, which a second bitmap tells, is cut into shards by the next word, as is
the empty prefix's, which holds the whole vocabulary.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from loomtally.llm.tables import durable
from loomtally.llm.words import WordHasher, positional_shingles, slices

LEAST = 100
LONGEST = 5
PERCENT = 100
TOP = 2_000
SPLIT_FROM, SHARDS, VOCABULARY_SHARDS = 100_000, 64, 1_024
BITS_PER_PHRASE, MIN_BITS, MAX_BITS = 16, 1 << 16, 1 << 26
# Characters whose words are counted at once.
CHARS = 4_000_000
# Parts a language's phrases are ranked in before their first ones meet.
RANKED_PARTS = 64

BREAK = b"\xff"  # no byte of UTF-8
PIECE_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)


class _Numbers(dict):
    """Numbers of words in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def words_and_breaks(texts: list) -> list[bytes]:
    """Words with A-Z in lower case and a `BREAK` wherever a piece ends, as it does with a text."""
    raw = BREAK.join([(text or "").encode("utf-8", "surrogatepass") for text in texts])
    lower = raw.lower().translate(PIECE_ENDS)
    return [*lower.replace(BREAK, b" " + BREAK + b" ").split(), BREAK]


def _slots(hashes: np.ndarray, lang: np.uint64, bits: int) -> np.ndarray:
    return (hashes ^ lang) % np.uint64(bits)


def _bitmaps(found: DataFrame, words: int) -> tuple[np.ndarray, int]:
    """Bits of the phrases of that many words, then of the common ones; at most `MAX_BITS` each."""
    bits = MIN_BITS
    wanted = min(MAX_BITS, BITS_PER_PHRASE * found.count())
    while bits < wanted:
        bits *= 2

    @F.pandas_udf("long")
    def slot(langs: pd.Series, phrases: pd.Series) -> pd.Series:
        if not len(phrases):
            return pd.Series([], dtype="int64")
        hasher = WordHasher()
        flat = [w for p in phrases for w in p.encode("utf-8", "surrogatepass").split(b" ")]
        own = hasher([s.encode("utf-8", "surrogatepass") for s in langs])
        return pd.Series(_slots(positional_shingles(hasher(flat), words)[::words], own, bits).astype(np.int64))

    numbered = found.select(slot("lang", "phrase").alias("slot"), "f")
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    common = F.when(F.col("f") >= SPLIT_FROM, bit).otherwise(F.lit(0).cast("bigint"))
    longs = numbered.groupBy(F.expr("slot div 64").alias("at")).agg(F.bit_or(bit).alias("v"), F.bit_or(common).alias("c"))
    table = longs.toPandas()
    bitmaps = np.zeros((2, bits // 64), np.int64)
    bitmaps[:, table["at"].to_numpy(np.int64)] = table[["v", "c"]].to_numpy(np.int64).T
    return bitmaps.view(np.uint64), bits


def _places(ids: np.ndarray, length: int) -> np.ndarray:
    """Whether `length` words without a break (0) start at each place."""
    breaks = np.flatnonzero(ids == 0)
    left = np.repeat(breaks, np.diff(np.append(-1, breaks))) - np.arange(len(ids))
    return left >= length


def _held(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _stripes_of(lang: str, texts: list, length: int, bitmaps, bits: int) -> dict:
    """Stripes of some texts: prefix, shard, offsets of stripes, next words and their counts."""
    numbers, found = _Numbers({BREAK: 0}), words_and_breaks(texts)
    ids = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
    words = list(numbers)
    hashes = WordHasher()(words)
    there = _places(ids, length)
    if length > 1:
        own = WordHasher()([lang.encode("utf-8", "surrogatepass")])
        slot = _slots(positional_shingles(hashes[ids], length - 1), own, bits)
        known = _held(bitmaps[0], slot)
        there = there[: len(known) - 1] & known[:-1] & known[1:]
    at = np.flatnonzero(there)
    name = np.zeros(len(at), np.int64)
    for k in range(length - 1):
        name = np.unique(name * len(words) + ids[at + k], return_inverse=True)[1].reshape(-1)
    keys, where, counts = np.unique(name * len(words) + ids[at + length - 1], return_index=True, return_counts=True)
    following = keys % len(words)
    if length == 1:
        shards = np.uint64(VOCABULARY_SHARDS)
    else:
        shards = np.where(_held(bitmaps[1], slot[at[where]]), SHARDS, 1).astype(np.uint64)
    shard = (hashes[following] % shards).astype(np.int64)
    order = np.lexsort((shard, keys // len(words)))
    owner, shard = (keys // len(words))[order], shard[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (shard[1:] != shard[:-1]))[: len(owner)])
    starts, known = at[where[order[first]]], pa.array(words, pa.binary())
    parts = [known.take(pa.array(ids[starts + k])) for k in range(length - 1)]
    return {
        "prefix": pc.binary_join_element_wise(*parts, b" ") if parts else pa.array([b""] * len(starts), pa.binary()),
        "shard": shard[first],
        "offsets": np.append(first, len(order)),
        "next": known.take(pa.array(following[order])),
        "n": counts[order],
    }


# Next words of a stripe are joined by spaces, their counts are eight bytes each: lists of
# strings would take several times the room in an exchange.
STRIPE = "lang string, prefix string, shard long, next string, n binary"


def _packed(counts: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values of consecutive counts, eight bytes each."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer((8 * offsets).astype(np.int32)), pa.py_buffer(counts.astype("<i8"))]
    )


def _unpacked(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), "<i8")


def stripes(docs: DataFrame, length: int, frequent=None, bits: int = 0) -> DataFrame:
    """Stripes of prefixes of `length - 1` words, several rows for a prefix; `docs` has `lang`, `text`."""
    def build(batches):
        bitmaps = None if frequent is None else np.frombuffer(frequent.value, np.uint64).reshape(2, -1)
        for batch in batches:
            langs, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
            for part in slices(texts, CHARS):
                here = langs[part]
                for lang in dict.fromkeys(here):
                    own = [t for t, k in zip(texts[part], here) if k == lang]
                    made = _stripes_of(lang, own, length, bitmaps, bits)
                    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(made["offsets"], pa.int32()), made["next"]), b" ")
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(made["prefix"]), pa.string()),
                        made["prefix"].cast(pa.string()),
                        pa.array(made["shard"], pa.int64()),
                        joined.cast(pa.string()),
                        _packed(made["n"], made["offsets"]),
                    ], names=["lang", "prefix", "shard", "next", "n"])

    return docs.select("lang", "text").mapInArrow(build, STRIPE)


class _Merge:
    """Adds up the stripes of each key, which come in order; the last key waits for more."""

    KEYS = ("lang", "prefix", "shard")

    def __init__(self, least: int) -> None:
        self.least, self.rest = least, None

    def __call__(self, batch: pa.RecordBatch | None) -> pa.RecordBatch | None:
        """Finished keys after another batch of stripes, or after the last one (None)."""
        parts = [part for part in (self.rest, batch) if part is not None and part.num_rows]
        if not parts:
            return None
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        opens = np.zeros(rows.num_rows, bool)
        opens[0] = True
        for column in self.KEYS:
            values = rows[column]
            opens[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        start = np.flatnonzero(opens)
        words = pc.split_pattern(rows["next"], " ")
        owner = np.repeat(np.cumsum(opens) - 1, pc.list_value_length(words).to_numpy())
        flat = pa.table({"g": owner, "next": words.flatten(), "n": _unpacked(rows["n"])})
        summed = flat.group_by(["g", "next"], use_threads=False).aggregate([("n", "sum")])
        summed = summed.take(pc.sort_indices(summed["g"])).combine_chunks()
        g, n = summed["g"].to_numpy(), summed["n_sum"].to_numpy()
        word, done = summed["next"].combine_chunks(), len(start) if batch is None else len(start) - 1
        cut = int(np.searchsorted(g, done))
        if batch is None:
            self.rest = None
        else:
            own, ends = rows.slice(int(start[-1]), 1), np.array([0, len(g) - cut])
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), word[cut:]), " ")
            self.rest = pa.RecordBatch.from_arrays(
                [*(own[c] for c in self.KEYS), joined, _packed(n[cut:], ends)], names=[*self.KEYS, "next", "n"]
            )
        total = np.bincount(g[:cut], n[:cut].astype(float), done) if done else np.zeros(0)
        often = np.flatnonzero(n[:cut] >= self.least)
        counts = np.bincount(g[often], minlength=done)
        prefix = rows["prefix"].take(pa.array(start[:done]))
        wanted = np.flatnonzero((counts > 0) | pc.equal(prefix, "").to_numpy(zero_copy_only=False)) if done else np.zeros(0, np.int64)
        if not len(wanted):
            return None
        offsets = pa.array(np.append(0, np.cumsum(counts[wanted])), pa.int32())
        return pa.RecordBatch.from_arrays([
            rows["lang"].take(pa.array(start[wanted])), prefix.take(pa.array(wanted)), pa.array(total[wanted].astype(np.int64)),
            pa.ListArray.from_arrays(offsets, word.take(pa.array(often))), pa.ListArray.from_arrays(offsets, pa.array(n[often])),
        ], names=["lang", "prefix", "total", "next", "n"])


def merged(parts: DataFrame, least: int) -> DataFrame:
    """One row per prefix and shard: `total` of its counts, and the next words counted `least` times."""

    def merge(batches):
        step = _Merge(least)
        for batch in batches:
            out = step(batch)
            if out is not None:
                yield out
        out = step(None)
        if out is not None:
            yield out

    return parts.repartition(*_Merge.KEYS).sortWithinPartitions(*_Merge.KEYS).mapInArrow(
        merge, "lang string, prefix string, total long, next array<string>, n array<long>"
    )


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Merged stripes of all phrases met `least` times, and the number of words per language.

    `docs` has `lang` and `text`. Stripes: `lang`, `prefix`, `total`, `next`, `n`, `words` (of a
    phrase, prefix and next word); one row per shard of a prefix.
    """
    levels, frequent, bits = [], None, 0
    for length in range(1, longest + 1):
        level = durable(merged(stripes(docs, length, frequent, bits), least).withColumn("words", F.lit(length)))
        if frequent is not None:
            frequent.destroy()
        levels.append(level)
        if length == longest or level.where(F.size("next") > 0).isEmpty():
            break
        bitmaps, bits = _bitmaps(phrases(level), length)
        frequent = docs.sparkSession.sparkContext.broadcast(bitmaps.tobytes())
    totals = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole, totals


def phrases(merged_stripes: DataFrame) -> DataFrame:
    """`lang`, `phrase`, `words`, `f` of each element of the stripes."""
    flat = merged_stripes.select("lang", "prefix", "words", F.explode(F.arrays_zip("next", "n")).alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.next")).otherwise(F.concat_ws(" ", "prefix", "e.next"))
    return flat.select("lang", phrase.alias("phrase"), "words", F.col("e.n").alias("f"))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, percent: int = PERCENT, top: int | None = TOP
) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`: the first `top` phrases of each language.

    Phrases of 2 to `longest` words that occur `a >= least` times within pieces, overlaps
    included. Cut after its first words, whose frequency is `l`, leaving others with `r`, a
    phrase scores `floor(1000 a n / (l r))`; the lowest cut counts, of equal ones the first.
    A phrase goes if a longer one that holds it occurs at least `percent` % as often; by one word
    longer is enough, as no phrase in between is less frequent. Order: score, then `a`, both
    descending, then phrase. With `top` None all are ranked, which puts a language in one task.

    A NULL language is `und`, a NULL text empty. Texts without a word add nothing. Every row
    counts, repeated ones and those without id too. Columns other than `lang` and `text` are
    not looked at.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases have two words and occur at least once")
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    table, totals = phrase_counts(docs, least, longest)
    known = durable(phrases(table))
    candidates = known.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    # The largest element of a phrase's own stripe, and of the stripes that end in it.
    after = table.where("prefix != '' AND size(next) > 0").select("lang", F.col("prefix").alias("phrase"), F.array_max("n").alias("f"))
    before = known.where("words > 1").select("lang", F.expr("substr(phrase, instr(phrase, ' ') + 1)").alias("phrase"), "f")
    longer = after.unionByName(before).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    )
    cut = kept.select("lang", "phrase", "a", F.split("phrase", " ").alias("w"), F.expr("explode(sequence(1, words - 1))").alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("rest"),
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parts = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    score = F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    scored = parts.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("c")
    ).select("lang", "phrase", "c.a", "c.l", "c.r", "c.n", "c.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if top is not None:
        scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
        ahead = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        scored = scored.withColumn("ahead", ahead).where(F.col("ahead") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = scored.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return ranked if top is None else ranked.where(F.col("rank") <= top)
