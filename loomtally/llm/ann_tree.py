"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is then put into a leaf of it. A query
walks the tree with a priority queue: the open node whose centre has the largest inner
product with the query is opened next, and leaves come out in the order they are worth
visiting. How many leaves to visit is widened until calibration queries, held against all
vectors, find `target` of their true neighbours.

Equal vectors are one entry with the smallest ids, of which a query can need no more than
`k + 1`. Entries are searched in shards (top subtrees, in blocks of bounded size) that meet
the queries visiting them, also in blocks, so neither a crowded leaf nor many queries gather
in one task.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loomtally.llm.tables import durable, shipped

K = 20
# Bounds: floats in the fitting sample, calibration queries, entries and queries per group.
SAMPLE_FLOATS = 4_000_000
CALIBRATION = 256
BLOCK, QUERY_BLOCK = 16_384, 4_096
BRANCHES, LEAF_ENTRIES, MAX_LEAVES, SHARDS = 8, 256, 8_192, 32
TARGET = 0.97
SEED = 7


@dataclass
class Tree:
    """Nodes by number; `children` is empty for leaves, which have a leaf number and a shard."""

    centers: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    shard: np.ndarray

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every level."""
        out = np.zeros(len(vectors), np.int64)
        work = [(0, np.arange(len(vectors)))]
        while work:
            node, rows = work.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
            elif len(rows):
                centers = self.centers[below]
                distance = (centers**2).sum(1) - 2 * vectors[rows] @ centers.T
                nearest = distance.argmin(1)
                work += [(child, rows[nearest == k]) for k, child in enumerate(below)]
        return out

    def visits(self, query: np.ndarray, leaves: int) -> list[int]:
        """The first leaves that best-bin-first search comes to."""
        worth = self.centers @ query
        queue, out = [(-worth[0], 0)], []
        while queue and len(out) < leaves:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-worth[child], child))
            else:
                out.append(self.leaf[node])
        return out


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centers = points[rng.choice(len(points), k, replace=False)]
    near = np.zeros(len(points), np.int64)
    for _ in range(10):
        near = ((centers**2).sum(1) - 2 * points @ centers.T).argmin(1)
        for c in range(k):
            if (near == c).any():
                centers[c] = points[near == c].mean(0)
    return near


def fit(sample: np.ndarray, leaves: int) -> Tree:
    """A tree of about `leaves` leaves; with few or equal points, of fewer."""
    rng, limit = np.random.default_rng(SEED), max(1, len(sample) // max(1, leaves))
    centers, children, leaf, members = [], [], [], [(None, np.arange(len(sample)))]
    parents: list[int | None] = []
    while members:
        parent, rows = members.pop(0)
        node = len(centers)
        centers.append(sample[rows].mean(0))
        children.append([])
        leaf.append(-1)
        parents.append(parent)
        if parent is not None:
            children[parent].append(node)
        parts = []
        if len(rows) > limit:
            near = _kmeans(sample[rows], min(BRANCHES, len(rows)), rng)
            parts = [rows[near == c] for c in range(BRANCHES) if (near == c).any()]
        if len(parts) > 1:
            members += [(node, part) for part in parts]
    number, shard = 0, []
    order = [0]
    while order:  # depth first, so that neighbouring leaves share a shard
        node = order.pop()
        if children[node]:
            order += children[node][::-1]
        else:
            leaf[node] = number
            number += 1
    shard = np.arange(number) * min(SHARDS, number) // number
    return Tree(np.array(centers), children, leaf, shard)


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `v` of vectors that take part: of the commonest length, finite, not zero."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0"
    )
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(~F.exists("v", bad)).where(F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c"))
    common = lengths.orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """`id` (smallest), `v`, `ids` (the k + 1 smallest) of each distinct vector.

    The rank limit is applied before the exchange, so copies by the thousand move as few rows.
    """
    order = Window.partitionBy("h", "v").orderBy("vec_id")
    ranked = rows.distinct().withColumn("h", F.xxhash64("v")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    return ranked.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("id"), "v", "ids"
    )


def _share(rows: DataFrame, key: str, wanted: int, total: int) -> DataFrame:
    """About `wanted` of `total` rows, chosen by a hash of the key."""
    if total <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(3), key), F.lit(1 << 30)) < int(wanted / total * (1 << 30)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, equal ones by smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, -k)[-k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def brute_force(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """True neighbours (`query_id`, `rank`, `vec_id`, `score`) of a bounded set of queries."""
    asked = queries.toPandas()
    shared = rows.sparkSession.sparkContext.broadcast((asked["vec_id"].to_numpy(np.int64), _matrix(asked["v"])))

    def search(batches):
        own, matrix = shared.value
        for batch in batches:
            ids, scores = batch["vec_id"].to_numpy(), _matrix(batch["v"]) @ matrix.T
            out = []
            for j, query in enumerate(own):
                for i in _top(np.where(ids == query, -np.inf, scores[:, j]), ids, k):
                    if ids[i] != query:
                        out.append((query, ids[i], scores[i, j]))
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = rows.select("vec_id", "v").mapInPandas(search, "query_id long, vec_id long, score double")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _leaves(tree, vector: Column) -> Column:
    @F.pandas_udf("int")
    def leaf(vectors: pd.Series) -> pd.Series:
        return pd.Series(tree.value.assign(_matrix(vectors)).astype(np.int32) if len(vectors) else [], dtype="int32")

    return leaf(vector)


def calibrated_visits(tree, n_leaves: int, indexed: DataFrame, queries: DataFrame, rows: DataFrame, k: int, target: float) -> int:
    """The fewest leaves whose visit finds `target` of the calibration queries' neighbours."""
    n = queries.count()
    asked = durable(_share(queries, "vec_id", CALIBRATION, n))
    truth = brute_force(asked, rows, k)
    # A neighbour is found in the leaf of its vector, whichever copy stands for it.
    placed = truth.join(rows.select("vec_id", _leaves(tree, F.col("v")).alias("leaf")), "vec_id").select("query_id", "leaf")
    vectors = {r["vec_id"]: np.array(r["v"], float) for r in asked.collect()}
    rank = {q: {leaf: i + 1 for i, leaf in enumerate(tree.value.visits(v, n_leaves))} for q, v in vectors.items()}
    needed = sorted(rank[r["query_id"]][r["leaf"]] for r in placed.collect())
    return needed[math.ceil(target * len(needed)) - 1] if needed else 1


def search(vectors: DataFrame, queries: Column, k: int = K, target: float = TARGET) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the k nearest found for the rows chosen by `queries`.

    Nearness is the inner product in double precision; a row is no neighbour of itself, but
    its copies are; equal scores go by the smaller id. Vectors that are NULL, empty, zero, of
    another length than most, or hold NULL or non-finite components take no part, nor do rows
    without id. Repeated rows count once; an id with several vectors may be found by each of them. Fewer than k candidates give fewer rows, an
    empty table none. Other columns are not looked at.
    """
    rows = durable(usable(vectors))
    spark = rows.sparkSession
    distinct = durable(entries(rows, k))
    total = distinct.count()
    asked = rows.where(queries).distinct()
    if total == 0:
        return asked.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "0D AS score").where(F.lit(False))
    width = len(distinct.first()["v"])
    sample = _matrix(_share(distinct, "id", max(1, SAMPLE_FLOATS // width), total).orderBy("id").toPandas()["v"])
    if len(sample) == 0:
        sample = _matrix(distinct.limit(1).toPandas()["v"])
    fitted = fit(sample, max(1, min(MAX_LEAVES, len(sample) // 16, total // LEAF_ENTRIES)))
    tree = shipped(spark, fitted)
    indexed = durable(distinct.withColumn("leaf", _leaves(tree, F.col("v"))))
    n_leaves = len(fitted.shard)
    visits = calibrated_visits(tree, n_leaves, indexed, asked, rows, k, target)

    shard_of = F.array(*[F.lit(int(s)) for s in fitted.shard])
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    load = np.zeros(SHARDS, np.int64)
    for leaf, n in sizes.items():
        load[fitted.shard[leaf]] += n
    blocks = F.array(*[F.lit(int(-(-n // BLOCK)) or 1) for n in load])
    n_queries = asked.count()
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))

    index = indexed.withColumn("shard", F.get(shard_of, F.col("leaf"))).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.get(blocks, F.col("shard"))).cast("int")
    ).withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def route(batches):
        for batch in batches:
            out = []
            for query, vector in zip(batch["vec_id"], _matrix(batch["v"])):
                chosen = np.array(tree.value.visits(vector, visits))
                shards = tree.value.shard[chosen]
                out += [(query, vector.astype(np.float32), int(s), chosen[shards == s].astype(np.int32)) for s in np.unique(shards)]
            yield pd.DataFrame(out, columns=["query_id", "q", "shard", "leaves"])

    routed = (
        asked.mapInPandas(route, "query_id long, q array<float>, shard int, leaves array<int>")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("shard")) - 1)))
        .withColumn("qblock", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
    )
    key = ["shard", "block", "qblock"]

    def meet(own: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if own.empty or visitors.empty:
            return pd.DataFrame([], columns=columns)
        own = own.sort_values(["leaf", "id"], ignore_index=True)
        matrix, ids, leaf = _matrix(own["v"]), own["id"].to_numpy(), own["leaf"].to_numpy()
        first, last = np.searchsorted(leaf, np.arange(n_leaves)), np.searchsorted(leaf, np.arange(n_leaves), "right")
        out = []
        for query, q, leaves in zip(visitors["query_id"], _matrix(visitors["q"]), visitors["leaves"]):
            at = np.concatenate([np.arange(first[x], last[x]) for x in leaves])
            scores = matrix[at] @ q
            for i in _top(scores, ids[at], k + 1):
                out += [(query, other, scores[i]) for other in own["ids"][at[i]] if other != query]
        return pd.DataFrame(out, columns=columns)

    found = index.groupBy(*key).cogroup(routed.groupBy(*key)).applyInPandas(meet, "query_id long, vec_id long, score double")
    return _ranked(found, k)


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of true neighbours found, for the queries of `truth`."""
    hit = truth.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi")
    n = truth.count()
    return hit.count() / n if n else 1.0
