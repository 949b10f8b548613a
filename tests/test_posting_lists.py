"""Compressed posting lists: coding, blocks, skipping and intersection."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtally.operators import posting_lists as P


@pytest.mark.parametrize("ids", [[5], [0, 1], [-(2**63), -1, 0, 127, 128, 2**14, 2**35, 2**63 - 1], list(range(-300, 90_000, 7))])
def test_ids_come_back(ids):
    array = np.array(ids, np.int64)
    assert P.unpacked(ids[0], P.packed_gaps(array)).tolist() == ids


def test_gaps_take_few_bytes():
    assert len(P.packed_gaps(np.arange(0, 100 * 1000, 100))) == 999
    assert len(P.packed_gaps(np.arange(0, 128 * 1000, 128))) == 2 * 999


def entries(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(rng.choice("abbbcd"), rng.choice([None, rng.randrange(-200, 400), 7])) for _ in range(3000)] + [("rare", 7), ("rare", -150)]


def test_blocks(rows):
    data = entries(1)
    lists = P.posting_lists(rows(data, "term string, doc int"), "doc", 64).collect()
    for row in lists:
        own = [i for t, i in data if t == row.term and i is not None and i // 64 == row.block]
        ids = sorted(set(own))
        assert (row.lo, row.hi, row.n, row.mentions) == (ids[0], ids[-1], len(ids), len(own))
        assert P.unpacked(row.lo, row.gaps).tolist() == ids and row.n <= 64
    assert len(lists) == len({(t, i // 64) for t, i in data if i is not None})


def test_a_key_that_repeats_is_one_id(spark):
    index = spark.range(50_000).select(F.lit("t").alias("term"), F.lit(9).alias("doc"))
    row = P.posting_lists(index, "doc").first()
    assert (row.n, row.mentions, bytes(row.gaps)) == (1, 50_000, b"")


@pytest.mark.parametrize("literal", [0, 1000])
@pytest.mark.parametrize("terms", [["a"], ["a", "b"], ["d", "rare", "b"], ["a", "nowhere"], ["a", "b", "c", "d", "rare"]])
def test_intersection(rows, terms, literal, monkeypatch):
    monkeypatch.setattr(P, "MAX_LITERAL_BLOCKS", literal)
    data = entries(2)
    lists = P.posting_lists(rows(data, "term string, doc int"), "doc", 16)
    held = [{i for t, i in data if t == term and i is not None} for term in terms]
    assert sorted(r.id for r in P.intersect(lists, terms).collect()) == sorted(set.intersection(*held))


def test_unpacked_lists_and_ranking(rows):
    data = entries(3)
    lists = P.posting_lists(rows(data, "term string, doc int"), "doc", 32)
    assert sorted(map(tuple, P.postings(lists).collect())) == sorted({(t, i) for t, i in data if i is not None})
    counts = {t: sum(x == t and i is not None for x, i in data) for t, _ in data}
    assert [tuple(r) for r in P.rank_from_lists(lists).collect()] == sorted(counts.items(), key=lambda c: (-c[1], c[0]))
    assert P.intersect(lists.where("false"), ["a"]).collect() == []


def scanned_rows(frame) -> int:
    """Rows that the file scan of a finished query handed on."""
    plan = frame._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            leaf = leaf.plan().collectLeaves().apply(0)
        total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_scan_skips_blocks(spark, tmp_path):
    path = str(tmp_path / "lists")
    common = spark.range(200_000).select(F.lit("common").alias("term"), F.col("id").alias("doc"))
    rare = spark.range(3).select(F.lit("rare").alias("term"), (F.col("id") + 150_000).alias("doc"))
    index = common.unionByName(rare)
    P.store(P.posting_lists(index, "doc", 10), path, 8)
    lists = P.stored(spark, path)
    assert lists.count() == 20_001
    needed = P.blocks_to_read(lists, ["common", "rare"])
    assert len(needed.collect()) == 2
    # Files, row groups or pages of other ranges are passed over before any row is handed on.
    assert scanned_rows(needed) < 10_000
    text = needed._jdf.queryExecution().toString()
    assert "PushedFilters" in text and "In(term" in text and "block" in text.split("PushedFilters")[1]
    assert [r.id for r in P.intersect(lists, ["common", "rare"]).orderBy("id").collect()] == [150_000, 150_001, 150_002]
    headers = P.surviving_blocks(lists, ["common", "rare"])
    assert "gaps" not in headers._jdf.queryExecution().executedPlan().toString()
