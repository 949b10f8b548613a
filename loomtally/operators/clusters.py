"""Integer k-means over weighted points and the report on its clusters."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomtally.defaults import (
    CLUSTERS, ETA, MAX_UPDATES, PROGRAMMING_LANGUAGES, SAMPLE_SEED, SMALL_SPREAD, TAG_SPREAD,
)
from loomtally.functions.points import Point, nearest, sq_distance, total_shift
from loomtally.operators.durable import durable
from loomtally.operators.journal import Journal
from loomtally.operators.medians import group_median
from loomtally.operators.sampling import fixed_sample, stratified_sample


@dataclass(frozen=True)
class Clustering:
    """Final centres, and how many updates led to them."""

    centers: list[Point]
    updates: int
    converged: bool


def collapse(vectors: DataFrame) -> DataFrame:
    """Identical points as one weighted row `x`, `y`, `w`; exact, since sums are integers."""
    return vectors.groupBy("x", "y").agg(F.count("*").alias("w"))


def assign(points: DataFrame, centers: Sequence[Point]) -> DataFrame:
    """Adds `cluster`, the index of the nearest centre."""
    return points.withColumn("cluster", nearest(centers))


def with_distance(points: DataFrame, to: Point) -> DataFrame:
    """Adds `sq_distance`, the squared distance to one point."""
    x, y = F.lit(to[0]), F.lit(to[1])
    return points.withColumn("sq_distance", sq_distance(F.col("x"), F.col("y"), x, y))


def _weighted_mean(axis: str) -> Column:
    return F.expr(f"cast(sum({axis} * w) div sum(w) as int)").alias(axis)


def update_step(points: DataFrame, centers: Sequence[Point]) -> DataFrame:
    """`cluster`, `x`, `y`: mean of the assigned points, truncating toward zero.

    Clusters without points are absent. Sums are combined map-side, so one row per
    cluster and task is shuffled.
    """
    return assign(points, centers).groupBy("cluster").agg(_weighted_mean("x"), _weighted_mean("y"))


def next_centers(points: DataFrame, centers: Sequence[Point]) -> list[Point]:
    """The updated centres; a cluster without points keeps its centre."""
    updated = list(centers)
    for row in update_step(points, centers).collect():
        updated[row["cluster"]] = (row["x"], row["y"])
    return updated


def kmeans(
    points: DataFrame,
    centers: Sequence[Point],
    eta: float = ETA,
    max_updates: int = MAX_UPDATES,
    journal: str | None = None,
) -> Clustering:
    """Updates until the summed squared shift of all centres falls below `eta`.

    `points` are weighted rows, best stored with `durable`. Centres travel as literals, so
    every update is one small job over the same plan and lineage does not grow.

    With a `journal` (a folder that outlives the session) every update is written down, and the
    iteration goes on from the last one that is there: over the same points and starting
    centres, it ends with the same centres as if it had never been interrupted.
    """
    if not centers:
        raise ValueError("k-means needs at least one centre")
    centers = [tuple(center) for center in centers]
    done, kept = 0, None
    if journal is not None:
        kept = Journal(points.sparkSession, journal, run_fingerprint(points, centers))
        latest = kept.latest()
        if latest is not None:
            done, rows = latest
            centers = [(row["x"], row["y"]) for row in sorted(rows, key=lambda row: row["cluster"])]
            if rows[0]["shift"] < eta:
                return Clustering(centers, done, True)
    for update in range(done + 1, max_updates + 1):
        moved = next_centers(points, centers)
        shift = total_shift(centers, moved)
        centers = moved
        if kept is not None:
            kept.record(update, centers_frame(points.sparkSession, centers).withColumn("shift", F.lit(shift)))
        if shift < eta:
            return Clustering(centers, update, True)
    return Clustering(centers, max(done, max_updates), False)


def run_fingerprint(points: DataFrame, centers: Sequence[Point]) -> str:
    """Stands for the points, whatever their order, and the starting centres."""
    seen = points.agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.bit_xor(F.xxhash64("x", "y", "w")).alias("h")).first()
    return hashlib.sha256(repr((tuple(seen), [tuple(map(int, c)) for c in centers])).encode()).hexdigest()


def centers_frame(spark: SparkSession, centers: Sequence[Point]) -> DataFrame:
    """`cluster`, `x`, `y` of the given centres."""
    rows = ", ".join(f"({i}, {int(x)}, {int(y)})" for i, (x, y) in enumerate(centers))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS centers(cluster, x, y)")


def centroid_shift(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: summed squared distance between centres of the same index.

    A cluster missing in `after` has not moved.
    """
    moved = before.alias("b").join(after.alias("a"), F.col("b.cluster") == F.col("a.cluster"))
    distance = sq_distance(F.col("b.x"), F.col("b.y"), F.col("a.x"), F.col("a.y"))
    return moved.agg(F.coalesce(F.sum(distance), F.lit(0.0)).alias("shift"))


def sample_centers(
    vectors: DataFrame,
    strata: int = len(PROGRAMMING_LANGUAGES),
    clusters: int = CLUSTERS,
    spread: int = TAG_SPREAD,
    seed: int = SAMPLE_SEED,
) -> list[Point]:
    """Starting centres drawn from the vectors, the same number for each tag.

    With a small spread tags overlap and the draw ignores them. The centres, `clusters`
    rows, are all that reaches the driver.
    """
    if clusters % strata != 0:
        raise ValueError("the number of clusters must be a multiple of the number of tags")
    if spread < SMALL_SPREAD:
        drawn = fixed_sample(vectors, clusters, seed=seed)
    else:
        drawn = stratified_sample(vectors, "x", clusters // strata)
    centers = [(row["x"], row["y"]) for row in drawn.orderBy("x", "y").limit(clusters + 1).collect()]
    if len(centers) != clusters:
        raise ValueError(f"drew {len(centers)} starting centres instead of {clusters}")
    return centers


def _cells(points: DataFrame, centers: Sequence[Point], spread: int) -> DataFrame:
    """`cluster`, `tag_index`, `y`, `w`: all the report needs to know about the points."""
    tag = F.expr(f"cast(x div {int(spread)} as int)")
    return (
        assign(points.where("y IS NOT NULL"), centers)
        .groupBy("cluster", tag.alias("tag_index"), "y")
        .agg(F.sum("w").alias("w"))
    )


def cluster_histogram(points: DataFrame, centers: Sequence[Point], spread: int) -> DataFrame:
    """`cluster`, `tag_index`, `n`: how often each tag occurs in each cluster."""
    tag = F.expr(f"cast(x div {int(spread)} as int)")
    return (
        assign(points, centers)
        .groupBy("cluster", tag.alias("tag_index"))
        .agg(F.sum("w").alias("n"))
    )


def cluster_report(
    points: DataFrame,
    centers: Sequence[Point],
    vocabulary: Sequence[str] = PROGRAMMING_LANGUAGES,
    spread: int = TAG_SPREAD,
    integer_percent: bool = False,
) -> DataFrame:
    """Dominant tag, its percentage, size and median score of every non-empty cluster.

    Sorted by median score. Equally frequent tags resolve to the first in the vocabulary.
    `integer_percent` divides before multiplying by 100, which leaves only 0 and 100.
    """
    names = F.array(*[F.lit(term) for term in vocabulary])
    cells = _cells(points, centers, spread)
    tops = (
        cells.groupBy("cluster", "tag_index")
        .agg(F.sum("w").alias("n"))
        .groupBy("cluster")
        .agg(F.max(F.expr("struct(n, -tag_index AS rank)")).alias("top"), F.sum("n").alias("size"))
        .alias("t")
    )
    medians = group_median(cells, "cluster", "y", F.col("w")).alias("m")
    percent = "top.n div size * 100" if integer_percent else "top.n * 100 / size"
    return (
        # Null-safe, so that both sides share the shuffled cells.
        tops.join(medians, F.col("t.cluster").eqNullSafe(F.col("m.cluster")))
        .select(
            "t.cluster",
            F.element_at(names, F.expr("1 - top.rank")).alias("label"),
            F.expr(percent).cast("double").alias("percent"),
            F.col("size").alias("cluster_size"),
            F.col("median").alias("median_score"),
        )
        .orderBy("median_score", "cluster")
    )


def weighted_points(vectors: DataFrame) -> DataFrame:
    """Collapsed points in durable storage, ready for repeated passes."""
    return durable(collapse(vectors))
