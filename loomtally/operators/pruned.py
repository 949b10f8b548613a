"""K-means that skips distances which cannot matter, with the same result as computing them all.

Each point keeps, from update to update, an upper bound of the distance to its own centre and a
lower bound of the distance to any other. When centres move, the upper bound grows by the move of
the own centre and the lower one shrinks by the largest move of another. A point whose upper bound
stays below the lower one, or below half the way from its centre to the next, keeps its centre
without a single distance; else its own distance is computed first, and all only if that doesn't
settle it. Bounds are compared with a margin above rounding, so a tie is always computed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtally.defaults import ETA, MAX_UPDATES
from loomtally.functions.points import Point, total_shift
from loomtally.operators.clusters import Clustering
from loomtally.operators.durable import durable, release

MARGIN = 1e-9
# Distances held in memory at once, and centres up to which their mutual distances are used.
CELLS, MUTUAL = 4_000_000, 5_000

STATE = "x int, y int, w long, cluster int, upper double, lower double, computed long"


@dataclass(frozen=True)
class PrunedClustering:
    """The clustering, and how many distances were computed of those a full pass would take."""

    clustering: Clustering
    computed: int
    possible: int

    @property
    def skipped(self) -> float:
        return 1 - self.computed / self.possible if self.possible else 0.0


def _half_gaps(centers: np.ndarray) -> np.ndarray:
    """Half the distance from each centre to the next one."""
    if len(centers) > MUTUAL:
        return np.zeros(len(centers))
    if len(centers) == 1:
        return np.full(1, np.inf)
    gaps = np.empty(len(centers))
    for at in range(len(centers)):
        squares = ((centers - centers[at]) ** 2).sum(axis=1)
        squares[at] = np.inf
        gaps[at] = np.sqrt(squares.min()) / 2
    return gaps


def _nearest_two(x: np.ndarray, y: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centre (the first of equal ones), its distance and that of the next."""
    cluster, first, second = np.empty(len(x), np.int32), np.empty(len(x)), np.full(len(x), np.inf)
    rows = max(1, CELLS // len(centers))
    for at in range(0, len(x), rows):
        part = slice(at, at + rows)
        squares = (x[part, None] - centers[:, 0]) ** 2 + (y[part, None] - centers[:, 1]) ** 2
        cluster[part] = squares.argmin(axis=1)
        first[part] = np.sqrt(squares.min(axis=1))
        if len(centers) > 1:
            second[part] = np.sqrt(np.partition(squares, 1, axis=1)[:, 1])
    return cluster, first, second


def reassigned(state: DataFrame, centers: Sequence[Point], before: Sequence[Point] | None) -> DataFrame:
    """The state after centres moved from `before`; in the first pass there is none, nor are bounds."""
    now = np.array(centers, float).reshape(-1, 2)
    moves = np.zeros(len(now)) if before is None else np.sqrt(((now - np.array(before, float)) ** 2).sum(axis=1))
    half, order = _half_gaps(now), np.argsort(moves)
    largest, others = int(order[-1]), float(moves[order[-2]]) if len(now) > 1 else 0.0

    def step(batches):
        for batch in batches:
            x, y = (batch[c].to_numpy().astype(float) for c in "xy")
            if before is None:
                cluster, upper, lower = np.zeros(len(x), np.int32), np.full(len(x), np.inf), np.zeros(len(x))
                computed = np.zeros(len(x), np.int64)
                open_ = np.arange(len(x))
            else:
                cluster, upper, lower = (batch[c].to_numpy().copy() for c in ("cluster", "upper", "lower"))
                computed = np.zeros(len(x), np.int64)
                upper = upper + moves[cluster]
                lower = lower - np.where(cluster == largest, others, moves[largest])
                limit = np.maximum(lower, half[cluster])
                open_ = np.flatnonzero(~(upper * (1 + MARGIN) + MARGIN < limit))
                own = now[cluster[open_]]
                upper[open_] = np.sqrt((x[open_] - own[:, 0]) ** 2 + (y[open_] - own[:, 1]) ** 2)
                computed[open_] = 1
                open_ = open_[~(upper[open_] * (1 + MARGIN) + MARGIN < limit[open_])]
            cluster[open_], upper[open_], lower[open_] = _nearest_two(x[open_], y[open_], now)
            computed[open_] = len(now)
            yield pa.RecordBatch.from_arrays(
                [batch["x"], batch["y"], batch["w"], *map(pa.array, (cluster, upper, lower, computed))],
                names=["x", "y", "w", "cluster", "upper", "lower", "computed"],
            )

    return state.mapInArrow(step, STATE)


def kmeans_pruned(
    points: DataFrame, centers: Sequence[Point], eta: float = ETA, max_updates: int = MAX_UPDATES
) -> PrunedClustering:
    """`clusters.kmeans` with bounds: the same centres after as many updates.

    `points` are weighted rows `x`, `y`, `w`. The state of an update is a stored table that
    replaces the one before. Centres are all that goes to tasks and comes back.
    """
    if not centers:
        raise ValueError("k-means needs at least one centre")
    centers = [tuple(center) for center in centers]
    state, before, computed, possible = points.select("x", "y", "w"), None, 0, 0
    converged = False
    for update in range(1, max_updates + 1):
        state = durable(reassigned(state, centers, before), replaces=None if before is None else state)
        means = state.groupBy("cluster").agg(
            F.expr("cast(sum(x * w) div sum(w) as int)").alias("x"), F.expr("cast(sum(y * w) div sum(w) as int)").alias("y"),
            F.sum("computed").alias("computed"), F.count("*").alias("n"),
        ).collect()
        moved = list(centers)
        for row in means:
            moved[row["cluster"]] = (row["x"], row["y"])
            computed, possible = computed + row["computed"], possible + row["n"] * len(centers)
        shift = total_shift(centers, moved)
        before, centers = centers, moved
        if shift < eta:
            converged = True
            break
    if before is not None:
        release(state)
    return PrunedClustering(Clustering(centers, update if max_updates else 0, converged), computed, possible)
