"""Nearest centre among very many, by a k-d tree over centres that are held in a table.

The tree is implicit: centres in an order in which every stretch is split at its middle, in turn
by x and by y, down to stretches of `LEAF` centres. A batch of points goes down it together: the
points of a node are divided by their side, and those whose nearest centre so far is no closer
than the dividing line visit the other side too. So a point looks at a few leaves instead of at
every centre. Equal distances fall to the lowest index, wherever in the tree it is. Of centres at
one place only that with the lowest index can be nearest, so a place is in the tree once: lines
divide nothing where many centres are equal, and every point would look at all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtally.operators.durable import durable, release

LEAF = 16
# Centres of one tree; a longer table is searched in blocks of this size, one after the other.
MAX_TREE_CENTERS = 500_000


class Tree:
    """Centres `x`, `y` with their indexes, in tree order."""

    def __init__(self, x: np.ndarray, y: np.ndarray, index: np.ndarray) -> None:
        self.points, self.index = np.stack([x, y], 1).astype(float), index.astype(np.int64)
        order = np.arange(len(x))
        # The dividing coordinate of a stretch, at the place of its middle.
        self.line = np.zeros(len(x))
        todo = [(0, len(x), 0)]
        while todo:
            low, high, axis = todo.pop()
            if high - low > LEAF:
                middle = (low + high) // 2
                part = order[low:high]
                order[low:high] = part[np.argpartition(self.points[part, axis], middle - low)]
                self.line[middle] = self.points[order[middle], axis]
                todo += [(low, middle, 1 - axis), (middle, high, 1 - axis)]
        self.points, self.index = self.points[order], self.index[order]

    def nearest(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of the nearest centre of each point, and distances computed."""
        asked = np.stack([x, y], 1).astype(float)
        best, found, computed = np.full(len(x), np.inf), np.full(len(x), np.iinfo(np.int64).max), 0
        # Points that visit a stretch, and how far its dividing line is from them.
        todo = [(0, len(self.index), 0, np.arange(len(x)), np.zeros(len(x)))] if len(self.index) else []
        while todo:
            low, high, axis, who, gap = todo.pop()
            who = who[gap <= best[who]]
            if not len(who):
                continue
            if high - low <= LEAF:
                offsets = asked[who, None] - self.points[None, low:high]
                squares = offsets[:, :, 0] * offsets[:, :, 0] + offsets[:, :, 1] * offsets[:, :, 1]
                computed += squares.size
                least = squares.min(axis=1)
                index = np.where(squares == least[:, None], self.index[low:high], np.iinfo(np.int64).max).min(axis=1)
                better = (least < best[who]) | ((least == best[who]) & (index < found[who]))
                best[who[better]], found[who[better]] = least[better], index[better]
                continue
            middle = (low + high) // 2
            beside = asked[who, axis] - self.line[middle]
            left, none = beside < 0, np.zeros(len(who))
            # The near side is searched first, so it is put on top.
            for ours, bounds in ((left, (middle, high)), (~left, (low, middle))):
                todo.append((*bounds, 1 - axis, who[ours], (beside * beside)[ours]))
            for ours, bounds in ((left, (low, middle)), (~left, (middle, high))):
                todo.append((*bounds, 1 - axis, who[ours], none[ours]))
        return found, best, computed


def places(centers: DataFrame) -> DataFrame:
    """`cluster`, `x`, `y`: of the centres at one place, that with the lowest index."""
    return centers.groupBy("x", "y").agg(F.min("cluster").alias("cluster")).select("cluster", "x", "y")


def _against(points: DataFrame, tree: Tree) -> DataFrame:
    """`points` (with `cluster`, `_best`) after the centres of one tree."""
    shared = points.sparkSession.sparkContext.broadcast((tree.points, tree.index, tree.line))

    def search(batches):
        own = Tree.__new__(Tree)
        own.points, own.index, own.line = shared.value
        for batch in batches:
            names = batch.schema.names
            here = [batch[c].to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y")]
            there = ~(np.isnan(here[0]) | np.isnan(here[1]))
            cluster, best = (batch[c].to_numpy(zero_copy_only=False).copy() for c in ("cluster", "_best"))
            found, squares, _ = own.nearest(here[0][there], here[1][there])
            known = there.nonzero()[0]
            better = (squares < best[known]) | ((squares == best[known]) & (found < cluster[known]))
            cluster[known[better]], best[known[better]] = found[better], squares[better]
            arrays = {**{n: batch[n] for n in names}, "cluster": pa.array(cluster), "_best": pa.array(best)}
            yield pa.RecordBatch.from_arrays([arrays[n] for n in names], names=names)

    return points.mapInArrow(search, points.schema)


def assign_from_table(points: DataFrame, centers: DataFrame) -> DataFrame:
    """`points` with `cluster`: the index of the nearest row of `centers` (`cluster`, `x`, `y`).

    Indexes are integers, each once. Distances are squared, in doubles; equal ones fall to the
    lowest index. A point with a NULL coordinate, and every point if there are no centres, has a
    NULL cluster; centres with a NULL are left out. The points' columns stay, whatever they are
    but `cluster` and `_best`. Centres are reduced to one per place, by a shuffle, and stored. Up
    to `MAX_TREE_CENTERS` places are collected and broadcast as one tree; more go in blocks of
    that size, of which one at a time is on the driver, and the points carry their best so far
    from block to block in a stored table.
    """
    known = centers.where("cluster IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    known = known.select(F.col("cluster").cast("bigint").alias("cluster"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    known = durable(places(known))
    none = F.lit(np.iinfo(np.int64).max).cast("bigint")
    state = points.withColumns({"cluster": none, "_best": F.lit(float("inf"))})
    blocks = -(-known.count() // MAX_TREE_CENTERS)
    previous = None
    for block in range(blocks):
        # Blocks by hash are of about equal size and need no order of the table.
        own = known if blocks == 1 else known.where(F.pmod(F.xxhash64("cluster"), F.lit(blocks)) == block)
        table = own.toPandas()
        state = _against(state, Tree(table["x"].to_numpy(), table["y"].to_numpy(), table["cluster"].to_numpy()))
        if blocks > 1:
            state = durable(state)
            if previous is not None:
                release(previous)
            previous = state
    release(known)
    return state.drop("_best").withColumn("cluster", F.when(F.col("cluster") < none, F.col("cluster")))
