"""Connected components of a stored edge table, by shuffles only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtally.llm.tables import durable
from loomtally.operators.durable import release
from loomtally.operators.skew import BLOCKS, marked, oversized_keys

# Rows of a group that one task reads in order; larger ones are spread.
GROUP_ROWS = 1_000_000
# Edges whose components one task works out.
TASK_EDGES = 2_000_000


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u").where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller end, as the large star leaves them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(
        F.explode(
            F.when(F.col("v") == F.col("m"), F.array(F.struct(F.col("u"), F.col("m").alias("v"))))
            .otherwise(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        ).alias("e")
    )
    return moved.select("e.u", "e.v").distinct()


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, each with the smallest one it is connected with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = np.split(at.ravel(), 2)
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        # Every root but the smallest around gets a smaller one.
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _reduced(edges: DataFrame) -> DataFrame:
    """At most one edge for each node that a task meets, to the smallest node it is connected with there."""

    def read(batches):
        kept, rows = [], 0
        for batch in batches:
            kept.append((batch["u"].to_numpy(), batch["v"].to_numpy()))
            rows += batch.num_rows
            if rows >= TASK_EDGES:
                kept = [_trees(kept)]
                rows = len(kept[0][0])
                if 2 * rows >= TASK_EDGES:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept[0]], names=["u", "v"])
                    kept, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _trees(kept)], names=["u", "v"])

    return edges.mapInArrow(read, "u long, v long")


def _trees(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    node, least = _forest(*(np.concatenate(x) for x in zip(*parts)))
    return node[node != least], least[node != least]


def _labelled(edges: DataFrame) -> DataFrame:
    """`node`, `component` of edges that one task holds."""

    def read(batches):
        parts = [(batch["u"].to_numpy(), batch["v"].to_numpy()) for batch in batches]
        if parts:
            columns = _forest(*(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["node", "component"])

    return edges.coalesce(1).mapInArrow(read, "node long, component long")


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (smallest reachable node) for every end of an edge `u`, `v` (long).

    Every task first leaves one edge a node of its own edges. Up to `TASK_EDGES` of these are
    worked out in one task. Of more, large and small stars in turn until nothing changes; each round
    is written to the shared folder. A node with very many neighbours is reduced to its minimum
    before the shuffle.
    """
    current = durable(_reduced(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    if current.count() <= TASK_EDGES:
        return durable(_labelled(current), replaces=current)
    current = durable(current.distinct(), replaces=current)
    before = _state(current)
    while before[0]:
        current = durable(_small_star(_large_star(current)), replaces=current)
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """`nodes` (column `node`) with `c`, the component that the links put each in."""
    known = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return nodes.join(known, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")


def _stored(rows: DataFrame) -> DataFrame:
    """The rows as a stored table, which they may be already."""
    return rows if getattr(rows, "_stored_at", None) else durable(rows)


class _Hubs:
    """Reads rows in order of group and node; drops repeats and groups of one, adds the first node."""

    def __init__(self) -> None:
        self.group = self.hub = self.last = None
        self.alone = False

    def __call__(self, g: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.group is not None:
            # The last group may go on; its first node is repeated in front, so that it isn't lost.
            g, node = np.append(self.group, g), np.append(self.last, node)
        opens = np.append(True, g[1:] != g[:-1])
        fresh = opens | np.append(True, node[1:] != node[:-1])
        g, node, opens = g[fresh], node[fresh], opens[fresh]
        start = np.flatnonzero(opens)
        first = node[start]
        if self.group is not None:
            first[0] = self.hub
        hub = np.repeat(first, np.diff(np.append(start, len(g))))
        size = np.repeat(np.diff(np.append(start, len(g))), np.diff(np.append(start, len(g))))
        keep = size > 1
        if self.group is not None and not (self.alone and keep[0]):
            keep[0] = False  # handed on before, or alone
        last_start = int(start[-1])
        open_alone = len(g) - last_start == 1 and (last_start > 0 or self.group is None or self.alone)
        self.group, self.hub, self.last, self.alone = g[-1], hub[-1], node[-1], open_alone
        return g[keep], node[keep], hub[keep]


def shared_groups(groups: DataFrame) -> DataFrame:
    """`g`, `node`, `hub` (the group's smallest node), each once, for groups of two nodes or more.

    One exchange of plain numbers; a task reads its rows in order and holds one batch, however
    large a group is. Groups that heavy keys make are spread by node and get their hub by a join.
    """

    def read(batches):
        hubs = _Hubs()
        for batch in batches:
            if batch.num_rows:
                columns = hubs(batch["g"].to_numpy(), batch["node"].to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["g", "node", "hub"])

    schema = "g long, node long, hub long"
    heavy = oversized_keys(groups, F.col("g"), GROUP_ROWS)
    if heavy is None:
        return groups.repartition("g").sortWithinPartitions("g", "node").mapInArrow(read, schema)
    known = marked(groups, F.col("g"), heavy)
    light = known.where(F.col(BLOCKS).isNull()).select("g", "node")
    large = known.where(F.col(BLOCKS).isNotNull()).select("g", "node").distinct()
    hubs = large.groupBy("g").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").drop("last")
    small = light.repartition("g").sortWithinPartitions("g", "node").mapInArrow(read, schema)
    return small.unionByName(large.join(F.broadcast(hubs) if heavy.small else hubs, "g").select("g", "node", "hub"))


def grouped_links(
    groups: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    all_hubs: bool = False,
    closer: Callable[[DataFrame], DataFrame] | None = None,
    within: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Verified links that connect whatever any verified pair within a group connects.

    `groups` has `g`, `node`, repeated rows and groups of one allowed, or else is a stored table that
    `shared_groups` could have made; `verify` takes pairs `a`, `b` and returns those linked, with
    more columns if it likes. The hub of a group is its smallest node. Every node is held against the smallest of all its hubs first, then against
    those hubs that are in another component still (with `all_hubs`: against all at once), and at
    last all pairs of a group that are in different components are compared. Pairs of one
    component need no comparison, so a large group of alike nodes costs little more than one
    comparison per node; unlike nodes that share a group are compared pair by pair. Where that is
    too much, `closer` takes the nodes of groups with several components, each once as `node`,
    `c` (component), and returns the pairs `a`, `b` among them, of different components, to which
    the last comparison is confined; all that `verify` would link must be among them. `within` does
    the same for rows of `g`, `node`, `c` without hubs, which have been held against all others.
    """
    stored = groups if "hub" in groups.columns else durable(shared_groups(groups))
    met = durable(stored.where("node != hub").select("node", F.col("hub").alias("x")).distinct())
    pair = (F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b"))
    nodes = durable(stored.select("node").distinct())
    first = met if all_hubs else met.groupBy("node").agg(F.min("x").alias("x"))
    done = durable(first.select(*pair).distinct())
    links = _stored(verify(done))
    labels = durable(_labels(nodes, links))
    other = labels.select(F.col("node").alias("x"), F.col("c").alias("cx"))
    if not all_hubs:
        more = met.join(labels, "node").join(other, "x").where("c != cx").select(*pair).distinct()
        more = durable(more.join(done, ["a", "b"], "left_anti"))
        done = durable(done.unionByName(more), replaces=done)
        links = durable(links.unionByName(verify(more)), replaces=links)
        labels = durable(_labels(nodes, links), replaces=labels)
        release(more)
    # Nodes of different components have been held against their hubs.
    labelled = (stored if closer else stored.where("node != hub")).select("g", "node").join(labels, "node")
    open_ = labelled.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("g")
    rest = labelled.join(open_, "g", "left_semi")
    rest = durable(rest if closer is None else rest.select("node", "c").distinct())
    release(stored, met)
    if within is not None:
        pairs = within(rest)
    elif closer is None:
        beside = rest.select("g", F.col("node").alias("x"), F.col("c").alias("cx"))
        pairs = rest.join(beside, "g").where("c < cx").select(*pair).distinct()
    else:
        pairs = closer(rest)
    last = _stored(verify(pairs.join(done, ["a", "b"], "left_anti")))
    found = durable(links.unionByName(last))
    release(links, last, rest, labels, done, nodes)
    return found
