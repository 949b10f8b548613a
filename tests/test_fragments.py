"""Ordered concatenation, layout and jobs from files."""

import random

import pytest
from pyspark.sql import functions as F

from loomtally.operators import fragments as G, skew
from loomtally.operators.layout import ordered_positions, range_layout
from loomtally.plans import jobs

SCHEMA = "k int, pos int, v string"
PIECES = [
    (40, 2, "on"), (40, 0, "hor"), (40, 1, "iz"), (-7, 5, "wind"), (-7, 9, "mill"),
    (12, 1, "b"), (12, 2, "a"), (12, 3, "s"), (12, 4, "al"), (12, 5, "t"), (12, 6, "ic"),
]
WHOLE = [(-7, "windmill"), (12, "basaltic"), (40, "horizon")]
FORMS = [G.keyed_concat, G.group_fold, G.aggregate_with]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("span", [65_536, 3, 2])
@pytest.mark.parametrize("partitions", [1, 7])
def test_concat(rows, form, span, partitions):
    joined = form(rows(PIECES, SCHEMA, partitions), "k", "pos", "v", span=span)
    assert sorted(tuple(r) for r in joined.collect()) == WHOLE


def test_sorted_by_key(rows):
    assert [tuple(r) for r in G.keyed_concat(rows(PIECES, SCHEMA), "k", "pos", "v").collect()] == WHOLE


def test_segments_make_up_the_whole(rows):
    parts = G.segments(rows(PIECES, SCHEMA), "k", "pos", "v", 2).orderBy("k", "segment").collect()
    texts = {}
    for r in parts:
        texts[r.k] = texts.get(r.k, "") + r.text
    assert sorted(texts.items()) == WHOLE and len(parts) == 8


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("lookup", [10_000, 1])
def test_hot_key(spark, monkeypatch, form, lookup):
    monkeypatch.setattr(skew, "MAX_LOOKUP_KEYS", lookup)
    rng = random.Random(1)
    data = [(0 if i % 3 == 0 else i % 40, i - 1000, rng.choice("xyz")) for i in range(3000)]
    expected = {}
    for k, pos, v in sorted(data):
        expected[k] = expected.get(k, "") + v
    frame = spark.createDataFrame(data, SCHEMA).repartition(6)
    assert dict(map(tuple, form(frame, "k", "pos", "v", span=50).collect())) == expected


@pytest.mark.parametrize("form", FORMS)
def test_heaps_of_copies(spark, form):
    data = [(0, i % 3, "ab"[i % 2]) for i in range(6000)] + [(1, 5, "z"), (1, 4, "y")]
    expected = {1: "yz", 0: "".join(v for _, _, v in sorted(data[:6000]))}
    frame = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert dict(map(tuple, form(frame, "k", "pos", "v", span=100).collect())) == expected
    cut = {(r.k, r.segment): r.text for r in G.segments(frame, "k", "pos", "v", 2).collect()}
    assert cut[0, 0] + cut[0, 1] == expected[0] and cut[1, 2] == "yz"


@pytest.mark.parametrize("form", [G.group_fold, G.aggregate_with])
def test_long_groups_fold_in_order(spark, form):
    frame = spark.range(20_000).selectExpr("1 AS k", "CAST(19999 - id AS INT) AS pos", "CAST(19999 - id AS STRING) || repeat('.', 90) AS v")
    [row] = form(frame, "k", "pos", "v").collect()
    assert row.text == "".join(f"{i}" + "." * 90 for i in range(20_000))


def test_user_defined_aggregate(rows):
    longest = G.Aggregator(
        zero=lambda: "", reduce=lambda b, v: max(b, v, key=len),
        merge=lambda a, b: max(a, b, key=len), finish=lambda b: f"<{b}>",
    )
    for span in (65_536, 2):
        got = G.aggregate_with(rows(PIECES, SCHEMA), "k", "pos", "v", longest, span)
        assert dict(map(tuple, got.collect())) == {-7: "<wind>", 12: "<al>", 40: "<hor>"}


def test_range_layout_cuts_common_keys(spark):
    frame = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("term"), "id")
    laid = range_layout(frame, 8, "term", "id").withColumn("p", F.spark_partition_id())
    bounds = laid.groupBy("p").agg(
        F.min(F.struct("term", "id")).alias("low"), F.max(F.struct("term", "id")).alias("high"),
        F.count("*").alias("n"), F.max((F.col("term") == "hot").cast("int")).alias("hot"),
    ).orderBy("p").collect()
    assert sum(b.n for b in bounds) == 4000 and sum(b.hot for b in bounds) > 1
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(bounds, bounds[1:]))


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_ordered_positions(spark, ranges):
    rng = random.Random(4)
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 1.5, float("nan"), 2.0]), rng.randrange(4)) for _ in range(900)]
    frame = spark.createDataFrame(data, "t string, x double, n int").repartition(4)
    got = ordered_positions(frame, "x", "t", ranges=ranges).collect()
    assert sorted(r.position for r in got) == list(range(1, 901))
    place = lambda v: (v is not None, v == v if v is None else v != v, v if v == v and v is not None else 0)
    in_order = sorted(data, key=lambda d: (place(d[1]), (d[0] is not None, d[0] or ""), d[2]))
    assert [str(tuple(r)[:3]) for r in sorted(got, key=lambda r: r.position)] == [str(d) for d in in_order]
    assert ordered_positions(frame.where("n > 9"), "x").collect() == []
    with pytest.raises(ValueError, match="already"):
        ordered_positions(frame, "x", name="n")


def test_positions_need_no_single_task(spark):
    hot = spark.range(50_000).select(F.lit("same").alias("t"), "id")
    laid = ordered_positions(hot, "t", ranges=8)
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_range" in plan
    sizes = laid.groupBy((F.col("position") > 0).alias("all")).agg(F.max("position").alias("m"), F.count("*").alias("n")).collect()
    assert [(r.m, r.n) for r in sizes] == [(50_000, 50_000)]


def test_jobs_from_files(spark, tmp_path):
    (tmp_path / "articles").mkdir()
    (tmp_path / "articles" / "a.txt").write_text(
        "".join(f"<page> <title>{t}</title><text>{x}</text> </page> \n"
                for t, x in [("1", "Java and Scala"), ("2", "Scala, Java"), ("3", "none")])
    )
    ranking = jobs.rank_articles(spark, str(tmp_path / "articles")).collect()
    assert [tuple(r) for r in ranking] == [("Java", 2), ("Scala", 1)]
    languages = ["JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS", "Objective-C",
                 "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy"]
    asked = [f"1,{i},,,0,{languages[i % 15]}" for i in range(1, 91)]
    replied = [f"2,{1000 + i},,{i},{i % 7}" for i in range(1, 91)]
    (tmp_path / "p.csv").write_text("\n".join(asked + replied))
    report = jobs.cluster_posting_file(spark, str(tmp_path / "p.csv")).collect()
    assert sum(r.cluster_size for r in report) == 90 and {r.label for r in report} == set(languages)


def test_positions_must_be_integers(rows):
    for form in (*FORMS, G.segments):
        with pytest.raises(ValueError, match="integers"):
            form(rows([(1, 0.5, "a")], "k int, pos double, v string"), "k", "pos", "v")


# x -> a x + b, one map after the other: associative, and its order matters.
MAPS = G.Aggregator(
    zero=lambda: (1, 0),
    reduce=lambda f, v: (f[0] * int(v) % 10007, (f[1] * int(v) + 3) % 10007),
    merge=lambda f, g: (f[0] * g[0] % 10007, (f[1] * g[0] + g[1]) % 10007),
    finish=lambda f: f"{f[0]} x + {f[1]}",
)


@pytest.mark.parametrize("span", [65_536, 40, 7])
@pytest.mark.parametrize("lookup", [10_000, 1])
@pytest.mark.parametrize("repeated", [False, True])
def test_monoid_of_maps(spark, monkeypatch, span, lookup, repeated):
    monkeypatch.setattr(skew, "MAX_LOOKUP_KEYS", lookup)
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", lookup)
    rng = random.Random(span)
    data = [(rng.choice([None, 0, 0, 0, 1, 2]), i - 700 if not repeated else rng.randrange(-50, 50) * rng.choice([1, 9]), str(rng.randrange(2, 9))) for i in range(2000)]
    data += [(5, 1, None), (6, 1, None), (6, -(2**40), "4"), (7, 2**40, "8")]
    expected = {}
    for k, _, v in sorted((d for d in data if d[2] is not None), key=lambda d: (str(d[0]), d[1], d[2])):
        expected[k] = MAPS.reduce(expected.get(k, MAPS.zero()), v)
    for order in (data, sorted(data, key=str)):
        frame = spark.createDataFrame(order, "k int, pos long, v string").repartition(6)
        got = G.aggregate_with(frame, "k", "pos", "v", MAPS, span)
        assert dict(map(tuple, got.collect())) == {k: MAPS.finish(f) for k, f in expected.items()}


def test_null_positions_come_first(spark):
    data = [(1, None, "b"), (1, 5, "c"), (1, None, "a"), (2, None, "z"), (2, -9, "y"), (3, None, "x")]
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert dict(map(tuple, G.aggregate_with(frame, "k", "pos", "v").collect())) == {1: "abc", 2: "zy", 3: "x"}


def test_buffers_are_shuffled_not_values(spark):
    ordered = spark.range(0, 100_000, 1, 4).selectExpr("id div 50000 AS k", "id AS pos", "'word ' AS v")
    buffers = G.partial_buffers(ordered, "k", "pos", "v", G.Aggregator(
        zero=lambda: 0, reduce=lambda n, v: n + len(v), merge=lambda a, b: a + b, finish=int))
    assert buffers.count() < 50
    lengths = G.aggregate_with(ordered, "k", "pos", "v", G.Aggregator(
        zero=lambda: 0, reduce=lambda n, v: n + len(v), merge=lambda a, b: a + b, finish=int), result="long")
    assert sorted(map(tuple, lengths.collect())) == [(0, 250_000), (1, 250_000)]


def test_buffers_of_any_type(rows):
    class Longest:
        def __init__(self, text=""):
            self.text = text

    longest = G.Aggregator(
        zero=Longest, reduce=lambda b, v: max(b, Longest(v), key=lambda x: len(x.text)),
        merge=lambda a, b: max(a, b, key=lambda x: len(x.text)), finish=lambda b: b.text,
    )
    got = G.aggregate_with(rows(PIECES, SCHEMA), "k", "pos", "v", longest)
    assert dict(map(tuple, got.collect())) == {-7: "wind", 12: "al", 40: "hor"}
