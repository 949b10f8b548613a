"""Points, medians, samples, k-means and the cluster report."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from loomtally.functions.ordering import seeded_order
from loomtally.functions.points import total_shift
from loomtally.operators import center_tree, clusters as C, medians, pruned, sampling
from loomtally.operators.medians import group_median
from loomtally.plans import jobs

POINTS = "x int, y int, w bigint"


def weighted(rows, *points):
    return rows([(x, y, 1) for x, y in points], POINTS)


def by_hand(points, centers, eta, updates):
    """Plain k-means with truncating means."""
    for n in range(1, updates + 1):
        members = {}
        for x, y in points:
            d = [(x - cx) ** 2 + (y - cy) ** 2 for cx, cy in centers]
            members.setdefault(d.index(min(d)), []).append((x, y))
        moved = list(centers)
        for i, own in members.items():
            moved[i] = tuple(int(sum(p[k] for p in own) / len(own)) for k in (0, 1))
        shift = total_shift(centers, moved)
        centers = moved
        if shift < eta:
            break
    return centers, n


@pytest.mark.parametrize("k", [1, 3, 400])
def test_nearest_takes_lowest_index_on_ties(rows, k):
    centers = [(0, 0), (10, 0), (0, 0)][:k] + [(10**6, i) for i in range(k - 3)]
    got = C.assign(weighted(rows, (5, 0), (5, 3), (9, 0), (0, 0)), centers).collect()
    assert {(r.x, r.y): r.cluster for r in got} == {
        (5, 0): 0, (5, 3): 0, (9, 0): 1 if k > 1 else 0, (0, 0): 0
    }


def test_nearest_without_centers(rows):
    assert [r.cluster for r in C.assign(weighted(rows, (1, 2)), []).collect()] == [0]


def test_distance_does_not_overflow(rows):
    far = C.with_distance(weighted(rows, (2147483647, 0)), (-2147483648, 0)).collect()[0]
    assert far.sq_distance == (2.0**32 - 1) ** 2


def test_means_truncate_toward_zero(rows):
    step = C.update_step(weighted(rows, (0, -3), (0, -4), (7, 2)), [(0, 0), (7, 2), (99, 99)])
    assert sorted(tuple(r) for r in step.collect()) == [(0, 0, -3), (1, 7, 2)]


def test_empty_cluster_keeps_its_center(rows):
    assert C.next_centers(weighted(rows, (1, 1)), [(0, 0), (0, 0), (50, 50)]) == [
        (1, 1), (0, 0), (50, 50)
    ]


def test_shift_equal_to_eta_is_not_converged(rows):
    points = weighted(rows, (2, 4))
    assert C.kmeans(points, [(0, 0)], eta=20.0, max_updates=1).converged is False
    assert C.kmeans(points, [(0, 0)], eta=20.1, max_updates=1).converged is True


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_kmeans_equals_plain_loop(spark, partitions):
    rng = random.Random(5)
    points = [(rng.choice([0, 50, 100]), rng.randint(-40, 40)) for _ in range(400)]
    centers = points[:6]
    frame = spark.createDataFrame(points, "x int, y int").repartition(partitions)
    found = C.kmeans(C.weighted_points(frame), centers, eta=1.0, max_updates=50)
    raw = C.kmeans(frame.withColumn("w", F.lit(1).cast("bigint")), centers, 1.0, 50)
    assert (found.centers, found.updates) == by_hand(points, centers, 1.0, 50)
    assert raw == found


def test_kmeans_parameters(rows):
    with pytest.raises(ValueError):
        C.kmeans(weighted(rows, (1, 1)), [])
    with pytest.raises(ValueError):
        total_shift([(0, 0)], [])


def test_centroid_shift(spark):
    before = C.centers_frame(spark, [(0, 0), (5, 5), (9, 9)])
    after = C.centers_frame(spark, [(3, 4), (5, 6)])
    assert C.centroid_shift(before, after).collect()[0].shift == 26.0
    assert C.centroid_shift(before, after.where("false")).collect()[0].shift == 0.0


# --- medians -------------------------------------------------------------------------

EVEN = [1, 3, 5, 7, 8, 10, 22, 34, 44, 55]


@pytest.mark.parametrize(
    "values, median",
    [(EVEN, 9), (EVEN + [56], 10), ([-3, -4], -3), ([5], 5), ([-5, 2], -1),
     ([2147483647, 2147483647], 2147483647), ([-2147483648, 2147483647], 0),
     ([7] * 5 + [9] * 5, 8), ([None, 4, None], 4)],
)
def test_median(rows, values, median):
    frame = rows([("g", v) for v in values], "g string, v int")
    assert [r.median for r in group_median(frame, "g", "v").collect()] == [median]


def test_medians_by_brute_force(spark):
    rng = random.Random(11)
    data = [(rng.choice("abc") if rng.random() < 0.9 else None,
             rng.choice([rng.randint(-5, 5), rng.randint(-10**9, 10**9), 65536 * rng.randint(-3, 3)]),
             rng.randint(0, 4)) for _ in range(600)]
    expected = {}
    for g, v, w in data:
        expected.setdefault(g, []).extend([v] * w)
    for g, values in expected.items():
        values.sort()
        n = len(values)
        expected[g] = (n, int((values[(n - 1) // 2] + values[n // 2]) / 2))
    frame = spark.createDataFrame(data, "g string, v int, w int").repartition(5)
    got = {r.g: (r.n, r.median) for r in group_median(frame, "g", "v", F.col("w")).collect()}
    assert got == expected


def test_median_needs_integers(rows):
    with pytest.raises(ValueError):
        group_median(rows([("g", 1.5)], "g string, v double"), "g", "v")


def middle(values):
    values = sorted(values)
    return values[(len(values) - 1) // 2], values[len(values) // 2]


@pytest.mark.parametrize("lookup", [1_000_000, 0])
def test_wide_medians(spark, monkeypatch, lookup):
    monkeypatch.setattr(medians, "MAX_BROADCAST_RANGES", lookup)
    rng = random.Random(12)
    whole = [2**63 - 1, -(2**63), 0, -1, 1, 2**47, 65535, -65536]
    data = []
    for _ in range(700):
        big = rng.choice([rng.choice(whole), rng.randint(-(2**63), 2**63 - 1), rng.randint(-9, 9)])
        real = rng.choice([0.0, -0.0, rng.gauss(0, 1), rng.uniform(-1e300, 1e300), float("inf"), -float("inf"), 5e-324, rng.randint(-3, 3) / 2])
        data.append((rng.choice(["a", "b", "b", "b", None]), big, real, Decimal(rng.randint(-(10**15) + 1, 10**15 - 1)).scaleb(-4), rng.randint(0, 3)))
    data += [("c", None, None, None, 1), ("d", 7, 1.5, Decimal("0.0001"), 0), ("e", -3, float("nan"), Decimal("-0.0001"), 1), ("e", -4, 2.0, Decimal("0.0002"), 1)]
    frame = spark.createDataFrame(data, "g string, big bigint, real double, exact decimal(15,4), w int").repartition(5)
    groups = {}
    for g, *row in data:
        groups.setdefault(g, []).extend([row] * row[3] if row[0] is not None else [])
    groups = {g: rows for g, rows in groups.items() if rows}
    half = lambda a, b: -(-(a + b) // 2) if a + b < 0 else (a + b) // 2
    got = {r.g: (r.n, r.median) for r in medians.group_median_wide(frame, "g", "big", F.col("w")).collect()}
    assert got == {g: (len(rows), half(*middle(r[0] for r in rows))) for g, rows in groups.items()}
    got = {r.g: r.median for r in medians.group_median_wide(frame, "g", "exact", F.col("w")).collect()}
    assert got == {g: sum(middle(r[2] for r in rows)) / 2 for g, rows in groups.items()}
    got = {r.g: r.median for r in medians.group_median_wide(frame, "g", "real", F.col("w")).collect()}
    assert math.isnan(got.pop("e"))
    expected = {g: (lambda a, b: (a + b) / 2)(*middle(r[1] for r in rows)) for g, rows in groups.items() if g != "e"}
    assert {g: repr(m) for g, m in got.items()} == {g: repr(m + 0.0) for g, m in expected.items()}


def test_wide_median_equals_the_narrow_one(spark):
    frame = spark.range(5000).selectExpr("id % 7 AS g", "cast(id * 7919 % 1000003 - 500000 AS int) AS v")
    narrow = {tuple(r) for r in group_median(frame, "g", "v").collect()}
    assert {tuple(r) for r in medians.group_median_wide(frame, "g", "v").collect()} == narrow
    assert medians.group_median_wide(frame.where("g > 9"), "g", "v").collect() == []
    with pytest.raises(ValueError, match="no median"):
        medians.group_median_wide(frame.selectExpr("g", "cast(v AS string) AS v"), "g", "v")


# --- bounds --------------------------------------------------------------------------


def spread_points(spark, n=20_000):
    return spark.range(n).select(
        (F.xxhash64("id") % 5000).cast("int").alias("x"), (F.xxhash64("id", F.lit(1)) % 5000).cast("int").alias("y"), (F.col("id") % 3 + 1).alias("w")
    )


def test_pruned_updates_give_the_same_centers(spark):
    points = spread_points(spark).cache()
    rng = random.Random(3)
    centers = [(rng.randint(-5000, 5000), rng.randint(-5000, 5000)) for _ in range(1000)]
    rows = np.array([tuple(r) for r in points.collect()], np.int64)
    means = [tuple(c) for c in centers]
    for _ in range(12):
        now = np.array(means, float)
        cluster = np.concatenate([
            ((part[:, None, :2] - now[None]) ** 2).sum(axis=2).argmin(axis=1) for part in np.array_split(rows.astype(float), 40)
        ])
        for j in range(1000):
            own = rows[cluster == j]
            if len(own):
                total = (own[:, :2] * own[:, 2:]).sum(axis=0).tolist()
                means[j] = tuple(int(t / own[:, 2].sum()) if abs(t) < 2**50 else t for t in total)
    found = pruned.kmeans_pruned(points, centers, eta=0.0, max_updates=12)
    assert found.clustering.centers == means and found.clustering.updates == 12
    assert found.possible == 12 * 20_000 * 1000 and found.skipped > 0.3
    points.unpersist()


@pytest.mark.parametrize("k", [1, 2, 7])
def test_pruned_equals_plain(spark, monkeypatch, k):
    points = spark.range(900).selectExpr("cast(id % 31 AS int) AS x", "cast(id % 29 AS int) AS y", "1L AS w")
    centers = [(i % 3, i % 3) for i in range(k)]
    plain = C.kmeans(points, centers, eta=0.5)
    assert pruned.kmeans_pruned(points, centers, eta=0.5).clustering == plain
    monkeypatch.setattr(pruned, "MUTUAL", 0)
    monkeypatch.setattr(pruned, "CELLS", 5)
    assert pruned.kmeans_pruned(points, centers, eta=0.5).clustering == plain
    assert pruned.kmeans_pruned(points.where("x < 0"), centers, eta=0.5).clustering == C.kmeans(points.where("x < 0"), centers, eta=0.5)


# --- centres in a table --------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 16, 17, 400])
def test_tree_finds_the_first_nearest(n):
    rng = np.random.default_rng(n)
    centers = rng.integers(-20, 20, (n, 2))
    index = rng.permutation(10 * n)[:n]
    asked = rng.integers(-30, 30, (3000, 2))
    found, squares, computed = center_tree.Tree(centers[:, 0], centers[:, 1], index).nearest(asked[:, 0], asked[:, 1])
    if n:
        exact = ((asked[:, None] - centers[None]) ** 2).sum(axis=2)
        assert (squares == exact.min(axis=1)).all()
        first = np.where(exact == exact.min(axis=1)[:, None], index, 10**9).min(axis=1)
        assert (found == first).all()
        assert n < 400 or computed < 0.5 * exact.size
    else:
        assert np.isinf(squares).all()


@pytest.mark.parametrize("limit", [500_000, 60])
def test_centers_from_a_table(spark, monkeypatch, limit):
    monkeypatch.setattr(center_tree, "MAX_TREE_CENTERS", limit)
    rng = random.Random(2)
    centers = [(i * 3 - 50, rng.randrange(25), rng.choice([None, *range(25)])) for i in range(300)]
    points = [(rng.choice([None, *range(-5, 30)]), rng.randrange(-5, 30), ["kept"]) for _ in range(500)]
    got = center_tree.assign_from_table(
        spark.createDataFrame(points, "x int, y int, more array<string>").repartition(3), spark.createDataFrame(centers, "cluster int, x int, y int")
    )
    def nearest(x, y):
        return x if x is None else min(((x - a) ** 2 + (y - b) ** 2, i) for i, a, b in centers if b is not None)[1]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((x, y, m, nearest(x, y))) for x, y, m in points)
    none = center_tree.assign_from_table(spark.createDataFrame(points, "x int, y int, more array<string>"), spark.createDataFrame([], "cluster int, x int, y int"))
    assert {r.cluster for r in none.collect()} == {None}


def test_centers_at_one_place_are_searched_once(spark, monkeypatch):
    """Equal centres can't be divided: all of them were held against every point near them."""
    sizes, built = [], center_tree.Tree.__init__

    def counted(self, x, y, index):
        sizes.append(len(x))
        built(self, x, y, index)

    monkeypatch.setattr(center_tree.Tree, "__init__", counted)
    centers = spark.range(3000).selectExpr("2999 - id AS cluster", "cast(id % 3 AS int) AS x", "cast(id % 2 AS int) AS y")
    points = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (9, 9), (None, 1)], "x int, y int")
    got = {(r.x, r.y): r.cluster for r in center_tree.assign_from_table(points, centers).collect()}
    lowest = {}
    for r in centers.collect():
        lowest[r.x, r.y] = min(r.cluster, lowest.get((r.x, r.y), 9999))
    assert sizes == [6]
    assert got == {(0, 0): lowest[0, 0], (1, 0): lowest[1, 0], (2, 1): lowest[2, 1], (9, 9): lowest[2, 1], (None, 1): None}


# --- samples -------------------------------------------------------------------------


def vectors(spark, n=600, strata=3, partitions=4):
    return spark.range(0, n, 1, partitions).selectExpr(
        "id", f"cast(id % {strata} * 50000 AS int) AS x", "cast(id % 17 AS int) AS y"
    )


@pytest.mark.parametrize("partitions", [1, 7])
def test_samples_ignore_partitioning(spark, partitions):
    one, other = vectors(spark), vectors(spark, partitions=partitions).orderBy("y")
    for draw in (
        lambda v: sampling.fixed_sample(v, 50),
        lambda v: sampling.stratified_sample(v, "x", 9),
        lambda v: sampling.fraction_sample(v, 0.2, "id"),
    ):
        assert sorted(map(tuple, draw(one).collect())) == sorted(map(tuple, draw(other).collect()))


def test_sample_sizes(spark):
    assert sampling.fixed_sample(vectors(spark), 50).count() == 50
    counts = sampling.stratified_sample(vectors(spark), "x", 9).groupBy("x").count().collect()
    assert [r["count"] for r in counts] == [9, 9, 9]
    drawn = sampling.fraction_sample(vectors(spark, 20_000), 0.2, "id").count()
    assert 3700 < drawn < 4300
    assert 3700 < sampling.fraction_sample(vectors(spark, 20_000), 0.2).count() < 4300
    assert sampling.fixed_sample(vectors(spark), 50, seed=1).count() == 50
    assert 20 < sampling.fraction_sample(vectors(spark, 100_000), 0.0004, "id").count() < 65
    assert sampling.fraction_sample(vectors(spark), 0.0, "id").count() == 0
    with pytest.raises(ValueError):
        sampling.fraction_sample(vectors(spark), 1.5, "id")


def test_stratified_draw_is_even_and_seeded(spark):
    v = vectors(spark, 30_000)
    ids = [r.id for r in sampling.stratified_sample(v, "x", 300).collect()]
    assert 13_000 < sum(ids) / len(ids) < 17_000
    other = [r.id for r in sampling.stratified_sample(v, "x", 300, seed=3).collect()]
    assert set(ids) != set(other)


def test_stratum_below_quota(spark):
    with pytest.raises(Exception, match="a stratum needs at least 201 rows"):
        sampling.stratified_sample(vectors(spark), "x", 201).collect()


def test_starting_centers(spark):
    v = vectors(spark)
    centers = C.sample_centers(v, strata=3, clusters=12)
    assert len(centers) == 12 and {x for x, _ in centers} == {0, 50000, 100000}
    assert len(C.sample_centers(v, strata=3, clusters=12, spread=10)) == 12
    with pytest.raises(ValueError, match="multiple"):
        C.sample_centers(v, strata=3, clusters=10)
    with pytest.raises(ValueError, match="instead of 16"):
        C.sample_centers(v, strata=4, clusters=16)


def test_rank_limit_runs_before_the_shuffle(spark):
    plan = sampling.stratified_sample(vectors(spark), "x", 3)._jdf.queryExecution()
    assert "WindowGroupLimit" in plan.executedPlan().toString()


@pytest.mark.parametrize("kept, heap", [(500_000, 20_000), (100, 64), (10, 1)])
def test_large_quotas(spark, monkeypatch, kept, heap):
    monkeypatch.setattr(sampling, "KEPT_ROWS", kept)
    monkeypatch.setattr(sampling, "HEAP_ROWS", heap)
    v = vectors(spark, 24_000).withColumn("x", F.when(F.col("id") % 40 == 0, None).when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7))
    v = v.withColumn("more", F.array(F.col("id"), F.lit(None)))
    ordered = F.row_number().over(Window.partitionBy("x").orderBy(seeded_order("id", 5), "id"))
    expected = v.withColumn("n", ordered).where("n <= 5000").drop("n")
    got = sampling.stratified_sample(v, "x", 5000, seed=5, short="keep")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert got.columns == v.columns
    assert sampling.stratified_sample(v.where("id < 0"), "x", 5000, short="keep").collect() == []
    with pytest.raises(Exception, match="a stratum needs at least 5000 rows"):
        sampling.stratified_sample(v, "x", 5000, seed=5).collect()


def test_tasks_send_no_more_than_the_quota(spark):
    v = vectors(spark, 90_000).withColumn("_order", seeded_order("id", 1))
    sent = sampling.leading_rows(v, "x", 5000, "id").withColumn("p", F.spark_partition_id())
    counts = sent.groupBy("p", "x").count().collect()
    assert len(counts) == 12 and {r["count"] for r in counts} == {5000}


# --- report --------------------------------------------------------------------------


def test_report(rows):
    points = rows(
        [(0, 1, 3), (0, 2, 1), (100, 80, 2), (100, 90, 5), (0, 91, 5), (100, 50, 0)], POINTS
    ).where("w > 0")
    centers = [(0, 0), (50, 90), (9000, 9000)]
    words = ["first", "second"]
    report = [tuple(r) for r in C.cluster_report(points, centers, words, 100).collect()]
    assert report == [(0, "first", 100.0, 4, 1), (1, "second", 700 / 12, 12, 90)]
    whole = C.cluster_report(points, centers, words, 100, integer_percent=True)
    assert [r.percent for r in whole.collect()] == [100.0, 0.0]


def test_tied_labels_take_the_first_term(rows):
    points = rows([(0, 1, 2), (100, 1, 2)], POINTS)
    assert C.cluster_report(points, [(50, 1)], ["first", "second"], 100).collect()[0].label == "first"


def test_cluster_postings(spark):
    schema = "posting_type int, id int, accepted_answer int, parent_id int, score int, tags string"
    asked = [(1, i, None, None, 0, ["Java", "PHP"][i % 2]) for i in range(60)]
    replied = [(2, 100 + i, None, i, i % 9, None) for i in range(60)]
    postings = spark.createDataFrame(asked + replied, schema)
    report = jobs.cluster_postings(postings, ["Java", "PHP"], 1000, 4, eta=1.0).collect()
    assert sum(r.cluster_size for r in report) == 60
    assert {r.label for r in report} == {"Java", "PHP"} and {r.percent for r in report} == {100.0}
    assert [r.median_score for r in report] == sorted(r.median_score for r in report)
