"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

Method. Each text becomes a sorted array of distinct shingle hashes (64 bits) and a hashed
bitmap. Texts with equal sets are one node, named by a digest of the set. Two sets can only be
similar if their sizes lie in the same or in neighbouring bands, and if no more than a certain
number of shingles are in one of them only. The hash space is cut into more segments than that,
so that similar sets are equal in a segment: a tile holds the sets of a band, and those of the
next smaller one that can reach it, that are equal there. Texts that only share a few shingles
don't meet. (Below `SEGMENT_PERCENT` segments would hold too little; there, a tile holds sets
that share one of their first shingles in an order known to all, rare ones first.) Inside a tile
every set is compared with the smallest node first; sets that are linked by then need no
comparison with each other. So a group of thousands of near copies costs a comparison or two
per copy.

What is left are sets in tiles of several components, mostly copies with a few changes too many.
They meet once more in tiles of their own: shingles are counted exactly and ordered by how many of
these sets alone have them, so that what a copy has changed comes first, and the place of a shared
shingle says how large a similar set can be. Only sets whose sizes fit both places are compared; sets with
more changes than that share no such tile, and no link is lost. Before two arrays are
intersected, the differing bits of their bitmaps bound the overlap from above.

Nothing is capped: every shingle, tile and pair is taken into account, at any size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomtally.llm.graph import components, grouped_links
from loomtally.llm.tables import durable, fresh, may_hold, rows_key, shipped
from loomtally.llm.words import WordHasher, mixed, positional_shingles, slices, words_of
from loomtally.operators.durable import release

SHINGLE_WORDS = 3
PERCENT = 90
BITMAP_BITS = 1024
# Load counters for the order of shingles, and how many travel in a row. Their number is fixed,
# whatever the corpus: with a larger one they tell only more common shingles from the rest.
COUNTER_BITS, BLOCK = 22, 65_536
# From this similarity on sets meet in segments; bands are so many times as wide there.
SEGMENT_PERCENT, WIDE = 88, 2
# Bands of sizes are cut into so many steps where the places of shared shingles count.
STEPS = 2
# Bits that every row of such a tile carries, to rule out pairs where they meet.
SKETCH_BITS = 256


def _sets(texts: pd.Series, size: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.unique(positional_shingles(hasher(words_of(text)), size))


def _counter(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _texts_sets(size: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[np.ndarray]]:
    def sets(batches):
        hasher = WordHasher()
        for batch in batches:
            yield from _sets(batch["text"], size, hasher)

    return sets


def shingle_load(rows: DataFrame, sets: Callable[[Iterator[pd.DataFrame]], Iterator[np.ndarray]]) -> np.ndarray:
    """How many of the `sets` of all rows have a shingle on each of the hash counters.

    A task hands on its counters in blocks of a byte each (at most 255 sets, which is enough to
    tell rare from common); blocks are added up one row after the other.
    """

    def count(batches):
        load = np.zeros(1 << COUNTER_BITS, np.uint32)
        for found in sets(batches):
            load[_counter(found)] += 1
        blocks = np.minimum(load, 255).astype(np.uint8).reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pd.DataFrame({"block": used, "load": [blocks[k].tobytes() for k in used]})

    def add(batches):
        block, total = None, None
        for batch in batches:
            for at, load in zip(batch["block"], batch["load"]):
                if at != block:
                    if block is not None:
                        yield pd.DataFrame({"block": [block], "load": [total.tobytes()]})
                    block, total = at, np.zeros(BLOCK, np.uint32)
                total += np.frombuffer(load, np.uint8)
        if block is not None:
            yield pd.DataFrame({"block": [block], "load": [total.tobytes()]})

    parts = rows.mapInPandas(count, "block long, load binary")
    added = parts.repartition("block").sortWithinPartitions("block").mapInPandas(add, "block long, load binary")
    load = np.zeros((1 << COUNTER_BITS) // BLOCK * BLOCK, np.uint32).reshape(-1, BLOCK)
    for row in added.collect():
        load[row["block"]] = np.frombuffer(row["load"], np.uint32)
    return np.minimum(load.reshape(-1), 65_535).astype(np.uint16)


def _band(size: int, percent: int, steps: float = 1) -> int:
    """Sizes of similar sets lie in the same or in neighbouring bands, or within so many steps."""
    return int(steps * math.log(size) / (math.log(100 / percent) * 1.000001))


def _ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def _bitmap(found: np.ndarray, bits: int) -> np.ndarray:
    """Whether an odd number of shingles fall on a bit: bits of two sets differ at most as often as these."""
    return np.packbits(np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1)


def _segment_keys(found: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Keys of which similar sets of a band share one.

    Sets that differ in `apart` shingles at most are equal in `spare` of `apart + spare` segments.
    Either one of these holds more than a shingle, or two of them that don't make a joint key.
    """
    largest = int(math.exp((band + 1) * WIDE * math.log(100 / percent) * 1.000001)) + 1
    apart = 2 * largest * (100 - percent) // (100 + percent)
    spare = 2 + apart // 32
    count = apart + spare
    # The shingles are sorted, and segments are ranges of their upper halves.
    held = np.bincount(((found >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64), minlength=count)
    total = np.append(np.uint64(0), np.cumsum(mixed(found), dtype=np.uint64))
    end = np.cumsum(held)
    key = mixed(total[end] - total[end - held] + mixed(np.arange(count, dtype=np.uint64) + np.uint64((band + 1) << 40)))
    sparse = key[held <= 1]
    if len(sparse) < spare:
        return key[held > 1]
    i, k = np.triu_indices(len(sparse), 1)
    return np.append(key[held > 1], mixed(sparse[i]) + sparse[k] * np.uint64(3))


def _shingle_keys(found: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the first shingles: those that similar sets of the band share, and those for the next one."""
    n, band = len(found), _band(len(found), percent)
    first = found[np.argsort(counts[_counter(found)], kind="stable")]
    home = first[: n - _ceil_div(percent * n, 100) + 1] + mixed(np.array([band], np.uint64))
    guest = first[: n - _ceil_div(2 * percent * n, 100 + percent) + 1] + mixed(np.array([band + 1], np.uint64))
    return mixed(np.append(home, guest))


def _tile_keys(found: np.ndarray, counts: np.ndarray | None, percent: int) -> np.ndarray:
    """Tiles of a set.

    Two different sets are similar at best if one has a single shingle more, so small sets, which
    even that would make too unlike, are in none.
    """
    n = len(found)
    if n * (100 - percent) < percent:
        return np.zeros(0, np.int64)
    if counts is not None:
        return _shingle_keys(found, counts, percent).view(np.int64)
    band, next_ = (_band(x, percent, 1 / WIDE) for x in (n, 100 * n // percent))
    keys = [_segment_keys(found, b, percent) for b in range(band, next_ + 1)]
    return np.concatenate(keys).view(np.int64)


def _profile(found: np.ndarray, counts: np.ndarray | None, percent: int) -> tuple:
    node = np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64)
    return node, len(found), _bitmap(found, BITMAP_BITS).tobytes(), _tile_keys(found, counts, percent)


def profiles(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: `node` (digest of its set), set size, bitmap and tiles."""
    load = shipped(docs.sparkSession, None if percent >= SEGMENT_PERCENT else shingle_load(docs.select("text"), _texts_sets(size)))

    def profile(batches):
        hasher, counts = WordHasher(), load.value
        names = ("node", "n_shingles", "bitmap", "tiles")
        for batch in batches:
            for part in slices(batch["text"]):
                out = [_profile(found, counts, percent) for found in _sets(batch["text"].iloc[part], size, hasher)]
                yield batch[["row", "doc_id"]].iloc[part].assign(**{c: [o[i] for o in out] for i, c in enumerate(names)})

    return docs.select(rows_key(docs).alias("row"), "doc_id", "text").mapInPandas(
        profile,
        "row long, doc_id long, node long, n_shingles long, bitmap binary, tiles array<long>",
    )


def _similar_bitmaps(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and differing bits leave room for enough overlap."""

    @F.pandas_udf("boolean")
    def possible(na: pd.Series, nb: pd.Series, ba: pd.Series, bb: pd.Series) -> pd.Series:
        if not len(na):
            return pd.Series([], dtype=bool)
        a = np.frombuffer(b"".join(ba), np.uint8).reshape(len(ba), -1)
        b = np.frombuffer(b"".join(bb), np.uint8).reshape(len(bb), -1)
        differing = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        total = na.to_numpy() + nb.to_numpy()
        overlap = np.minimum((total - differing) // 2, np.minimum(na, nb).to_numpy())
        return pd.Series(100 * overlap >= percent * (total - overlap))

    a = signatures.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("bitmap").alias("ba"))
    b = signatures.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("bitmap").alias("bb"))
    near = (F.least("na", "nb") * 100) >= (F.greatest("na", "nb") * percent)
    return (
        pairs.join(a, "a").join(b, "b").where(near)
        .where(possible("na", "nb", "ba", "bb")).select("a", "b")
    )


def _node_sets(nodes: DataFrame, docs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """`node`, `s` (its sorted array), stored, for distinct nodes; `rows` has a row of each node."""

    def shingles(batches):
        hasher = WordHasher()
        for batch in batches:
            for part in slices(batch["text"]):
                found = [s.astype(np.int64) for s in _sets(batch["text"].iloc[part], size, hasher)]
                yield pd.DataFrame({"node": batch["node"].iloc[part].to_numpy(), "s": pd.Series(found, dtype=object)})

    needed = durable(rows.join(nodes, "node").select("node", "row"))
    texts = docs.select(rows_key(docs).alias("row"), "text").where(may_hold(needed, "row", F.col("row")))
    one_each = texts.join(needed, "row").groupBy("node").agg(F.first("text").alias("text"))
    return durable(one_each.mapInPandas(shingles, "node long, s array<long>"))


def _exact(pairs: DataFrame, docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose sorted arrays meet the similarity exactly; `rows` has a row of each node."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(a, b):
            small, large = (a, b) if len(a) <= len(b) else (b, a)
            small, large = small.view(np.uint64), large.view(np.uint64)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            return 100 * both >= percent * (len(a) + len(b) - both)

        return pd.Series([one(a, b) for a, b in zip(left, right)], dtype=bool)

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _node_sets(ends, docs, rows, size)
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
        .where(linked("sa", "sb"))
        .select("a", "b")
    )


def _shared_shingles(sets: DataFrame) -> DataFrame:
    """`node`, `shared`: the shingles that other sets have too, those of the fewest sets first.

    Sets are distinct, and so are the shingles of a set. Counted by shuffles, as counters of a
    fixed number would take ever more shingles of one set alone for shared ones.
    """
    each = sets.select("node", F.explode("s").alias("s"))
    counts = each.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
    ordered = F.sort_array(F.collect_list(F.struct("f", "s")))["s"]
    return each.join(counts, "s").groupBy("node").agg(ordered.alias("shared"))


def _places(n: int, shared: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Where a set of `n` meets similar ones: shingle, step of the smaller set, largest size, own step.

    A set whose first shared shingle has `i` others before it shares at most `n - i`, which is
    enough for sets of a size up to `most`. Two sets meet in the step of the smaller one's size.
    Shingles that no other set has only take the first places.
    """
    alone = n - len(shared)
    met = shared[: max(0, n - _ceil_div(percent * n, 100) + 1 - alone)]
    most = (n - alone - np.arange(len(met))) * (100 + percent) // percent - n
    least = max(1, _ceil_div(percent * n, 100))
    met, most = met[most >= least], most[most >= least]
    own = _band(n, percent, STEPS)
    last = np.array([_band(min(n, int(m)), percent, STEPS) for m in most], np.int64)
    steps = np.arange(_band(least, percent, STEPS), own + 1)
    at, k = np.nonzero(last[:, None] >= steps[None, :])
    return met[at], steps[k], most[at], steps[k] == own


def _close_pairs(nodes: DataFrame, docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs `a`, `b` of different `c` that may be similar, of all of `nodes` (`node`, `c`)."""
    sets = _node_sets(nodes.select("node"), docs, rows, size)
    sketch = [f"x{k}" for k in range(SKETCH_BITS // 64)]

    def places(batches):
        names = ("node", "c", "n", *sketch, "s", "step", "most", "own")
        for batch in batches:
            out, held = [], 0
            for node, c, found, shared in zip(batch["node"], batch["c"], batch["s"], batch["shared"]):
                met = _places(len(found), shared, percent)
                own = (node, c, len(found), *_bitmap(found.view(np.uint64), SKETCH_BITS).view(np.int64))
                out.append((*(np.full(len(met[0]), x) for x in own), *met))
                held += len(met[0])
                if held >= BLOCK:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))
                    out, held = [], 0
            if out:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))

    longs = ", ".join(f"{x} long" for x in ("node", "c", "n", *sketch, "s", "step", "most"))
    placed = sets.join(_shared_shingles(sets), "node").join(nodes, "node").mapInPandas(places, f"{longs}, own boolean")
    placed = durable(placed.select(F.xxhash64("s", "step").alias("g"), "node", "c", "n", *sketch, "most", "own"))
    carried = ("node", "c", "n", *sketch, "most")
    smaller = placed.where("own AND most >= n").select("g", *(F.col(x).alias(f"{x}_") for x in carried))
    differing = " + ".join(f"bit_count({x} ^ {x}_)" for x in sketch)
    fits = f"c != c_ AND n_ <= n AND n <= most_ AND n_ <= most AND ({differing}) * {100 + percent} <= (n + n_) * {100 - percent}"
    pairs = durable(
        placed.join(smaller, "g").where(fits)
        .select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()
    )
    release(sets, placed)
    return pairs


def jaccard_components(
    docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """`row`, `doc_id`, `n_shingles`, `component_id` for every row of `docs`.

    `component_id` is the smallest doc_id reachable over links, the row's own included.
    A NULL, empty or blank text has an empty set and is linked with nothing. A text shorter
    than a shingle is one shingle, its whole word sequence. Equal texts under different ids
    are linked; repeated rows give the same row again. A NULL doc_id counts as larger than
    any id: its component takes the smallest id it reaches, NULL if there is none. Other
    columns of `docs`, whatever their names, are not looked at.
    """
    docs = docs.select("doc_id", "text")
    all_rows = durable(profiles(docs, size, percent))
    sets = all_rows.where("n_shingles > 0")
    classes = durable(sets.groupBy("node").agg(F.min("row").alias("row"), F.min("doc_id").alias("least_id")))
    signatures = durable(sets.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap")))

    def verify(pairs: DataFrame) -> DataFrame:
        return _exact(durable(_similar_bitmaps(pairs, signatures, percent)), docs, classes, size, percent)

    def close(nodes: DataFrame) -> DataFrame:
        return _close_pairs(nodes, docs, classes, size, percent)

    links = grouped_links(sets.select(F.explode("tiles").alias("g"), "node"), verify, closer=close)
    linked = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    grouped = classes.join(linked, "node", "left").select("node", "least_id", F.coalesce("component", "node").alias("c"))
    least = grouped.groupBy("c").agg(F.min("least_id").alias("component_id"))
    found = grouped.join(least, "c").select("node", "component_id")
    return all_rows.select("row", "doc_id", "node", "n_shingles").join(found, "node", "left").select(
        "row", "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component, with all columns of `docs`.

    Documents without words stay. Of rows with the same id and text, all stay or all go; of
    equal texts without id none goes.
    """
    found = jaccard_components(docs, size, percent).where("component_id < doc_id OR (doc_id IS NULL AND component_id IS NOT NULL)")
    return _without(docs, found.select("row").distinct())


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    name = fresh(docs, "_llm_row")
    gone = rows.select(F.col("row").alias(name))
    return docs.withColumn(name, rows_key(docs)).join(gone, name, "left_anti").select(*docs.columns)
