"""Life cycle of stored tables and iterations taken up again."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from loomtally.operators import clusters as C, durable as D
from loomtally.operators.journal import Journal
from loomtally.plans import jobs
from loomtally.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
STORING = ["kmeans", "kmeans_resumed", "cluster_report", "udaf_concat", "posting_intersect", "qa_grouped", "survey_file", "nearest_center"]


def names(spark):
    return set(D.entries(spark, D.shared_folder(spark)))


def test_superseded_tables_go(spark):
    before = names(spark)
    one = D.durable(spark.range(10))
    two = D.durable(one.where("id > 4"), replaces=one)
    assert sorted(r.id for r in two.collect()) == [5, 6, 7, 8, 9]
    assert len(names(spark) - before) == 1
    D.release(two)
    assert names(spark) == before
    with pytest.raises(ValueError, match="only a table"):
        D.release(spark.range(3))


def test_cleared_blocks(spark):
    outer = D.durable(spark.range(3))
    before, paths = names(spark), D.stored_paths(spark)
    with pytest.raises(ZeroDivisionError), D.cleared(spark):
        D.durable(spark.range(4))
        D.new_path(spark, "unused")
        assert len(D.stored_paths(spark)) == len(paths) + 2
        1 / 0
    assert names(spark) == before and D.stored_paths(spark) == paths and outer.count() == 3
    D.release(outer)


@pytest.mark.parametrize("name", STORING)
def test_queries_leave_nothing_behind(spark, name):
    before = names(spark)
    with D.cleared(spark):
        assert QUERIES[name](spark, SMALL).collect()
    assert names(spark) == before


def test_queries_without_a_table_in_their_result_leave_nothing_at_all(spark):
    before = names(spark)
    for name in ("kmeans", "kmeans_resumed"):
        assert QUERIES[name](spark, SMALL).collect()
    assert names(spark) == before


def test_unfinished_tables_are_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    D.durable_at(spark.range(5), path)
    assert D.durable_at(spark.range(9), path).count() == 5
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert D.durable_at(spark.range(9), path).count() == 9
    assert path not in D.stored_paths(spark)


class Lost(Exception):
    pass


def start(spark):
    points = spark.range(500).select(
        (F.col("id") * 37 % 211).cast("int").alias("x"), (F.col("id") * F.col("id") % 97).cast("int").alias("y"), F.lit(1).cast("long").alias("w")
    )
    return points, [(0, 0), (1, 0), (2, 1), (3, 5), (210, 90)]


def test_a_lost_driver_loses_one_update_at_most(spark, tmp_path, monkeypatch):
    points, centers = start(spark)
    whole = C.kmeans(points, centers, eta=0.5)
    assert whole.updates > 4
    folder, step, calls = str(tmp_path / "j"), C.next_centers, []

    def failing(p, c):
        if len(calls) == 2:
            raise Lost
        calls.append(1)
        return step(p, c)

    monkeypatch.setattr(C, "next_centers", failing)
    with pytest.raises(Lost):
        C.kmeans(points, centers, eta=0.5, journal=folder)
    assert D.entries(spark, folder) == ["step-000000002"]
    calls.clear()
    monkeypatch.setattr(C, "next_centers", lambda p, c: calls.append(1) or step(p, c))
    assert C.kmeans(points.repartition(3), centers, eta=0.5, journal=folder) == whole
    assert len(calls) == whole.updates - 2
    calls.clear()
    assert C.kmeans(points, centers, eta=0.5, journal=folder) == whole and calls == []
    assert len(D.entries(spark, folder)) == 1


def test_half_written_steps_do_not_count(spark, tmp_path):
    points, centers = start(spark)
    folder = str(tmp_path / "j")
    C.kmeans(points, centers, eta=0.5, max_updates=3, journal=folder)
    half = tmp_path / "j" / "step-000000004"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    assert C.kmeans(points, centers, eta=0.5, journal=folder) == C.kmeans(points, centers, eta=0.5)


def test_a_journal_of_other_input_is_an_error(spark, tmp_path):
    points, centers = start(spark)
    folder = str(tmp_path / "j")
    C.kmeans(points, centers, max_updates=1, eta=0.5, journal=folder)
    with pytest.raises(ValueError, match="another run"):
        C.kmeans(points.where("x > 3"), centers, eta=0.5, journal=folder)
    with pytest.raises(ValueError, match="another run"):
        C.kmeans(points, centers[::-1], eta=0.5, journal=folder)
    assert Journal(spark, str(tmp_path / "none"), "x").latest() is None


def test_a_job_goes_on_from_its_folder(spark, tmp_path):
    schema = "posting_type int, id int, accepted_answer int, parent_id int, score int, tags string"
    asked = [(1, i, None, None, 0, ["Java", "PHP"][i % 2]) for i in range(60)]
    replied = [(2, 100 + i, None, i, i % 9, None) for i in range(60)]
    postings = spark.createDataFrame(asked + replied, schema)
    whole = jobs.cluster_postings(postings, ["Java", "PHP"], 1000, 4, eta=1.0).collect()
    folder = str(tmp_path / "job")
    jobs.cluster_postings(postings, ["Java", "PHP"], 1000, 4, eta=1.0, max_updates=1, journal=folder)
    again = jobs.cluster_postings(postings, ["Java", "PHP"], 1000, 4, eta=1.0, journal=folder).collect()
    assert again == whole and {"points", "vectors"} < set(D.entries(spark, folder))


def test_catalogue_is_registered():
    assert QUERIES.keys() <= queries().keys()
