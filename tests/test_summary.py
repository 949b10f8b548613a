"""Column groups, buckets, summaries and the three grouped forms."""

import random

import pytest
from pyspark.sql import functions as F

from loomtally.functions import survey as columns
from loomtally.operators import summary as S
from loomtally.plans import jobs

HEADER = ("tucaseid teage telfs tesex t010101 t030101 t110101 t180101 t180301 t050101 t180501 "
          "t020101 t060101 t180201 t170101 t500101").split()
GROUPS = {
    "primaryNeeds": ["t010101", "t030101", "t110101", "t180101", "t180301"],
    "work": ["t050101", "t180501"],
    "other": ["t020101", "t060101", "t180201"],
}
SCHEMA = "tucaseid string, " + ", ".join(f"{c} double" for c in HEADER[1:])


def respondent(teage=30.0, telfs=1.0, tesex=1.0, **minutes):
    return ("id", teage, telfs, tesex, *[float(minutes.get(c, 0)) for c in HEADER[4:]])


def test_groups_of_the_header():
    assert columns.column_groups(HEADER) == GROUPS


def test_groups_are_case_sensitive_prefixes_in_priority_order():
    names = ["T0101", "xt01", "t1801", "t1805", "t1802", "t18", "t17", "t50", "t0", "t02x", "t0201"]
    assert columns.column_groups(names) == {
        "primaryNeeds": ["t1801"], "work": ["t1805"], "other": ["t1802", "t18", "t02x", "t0201"]
    }


def test_groups_of_random_names_agree_with_labels_in_data(rows):
    rng = random.Random(3)
    names = sorted({f"t{rng.randint(1, 18):02d}{rng.randint(0, 999)}" for _ in range(300)})
    labels = {
        r.name: r.label
        for r in rows([(n,) for n in names], "name string")
        .select("name", columns.group_label(F.col("name")).alias("label")).collect()
    }
    assert labels == {n: columns.group_of(n) for n in names}
    placed = [n for group in columns.column_groups(names).values() for n in group]
    assert len(placed) == len(set(placed)) == sum(v is not None for v in labels.values())


@pytest.mark.parametrize(
    "telfs, status",
    [(0.0, "not working"), (1.0, "working"), (2.0, "working"), (2.5, "working"),
     (3.0, "not working"), (4.0, "not working"), (5.0, None), (None, None), (float("nan"), None)],
)
def test_working_status_and_employability(rows, telfs, status):
    got = S.summarize(rows([respondent(telfs=telfs)], SCHEMA)).collect()
    assert [r.working for r in got] == ([] if status is None else [status])


@pytest.mark.parametrize(
    "teage, band",
    [(14.0, "elder"), (15.0, "young"), (22.0, "young"), (22.5, "elder"), (23.0, "active"),
     (55.0, "active"), (56.0, "elder"), (None, "elder"), (float("nan"), "elder")],
)
def test_age_band(rows, teage, band):
    assert S.summarize(rows([respondent(teage=teage)], SCHEMA)).collect()[0].age == band


@pytest.mark.parametrize("tesex, label", [(1.0, "male"), (2.0, "female"), (None, "female")])
def test_sex(rows, tesex, label):
    assert S.summarize(rows([respondent(tesex=tesex)], SCHEMA)).collect()[0].sex == label


def test_summary_row(rows):
    minutes = dict(t010101=60, t110101=30, t180301=30, t050101=90, t180501=30, t020101=15,
                   t180201=15, t170101=600, t500101=600)
    got = S.summarize(rows([respondent(**minutes)], SCHEMA))
    assert [tuple(r) for r in got.collect()] == [("working", "male", "active", 2.0, 2.0, 0.5)]
    assert [f.dataType.simpleString() for f in got.schema] == ["string"] * 3 + ["double"] * 3


def test_row_sum_of_many_columns(spark):
    wide = spark.range(3).select(*[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(450)])
    got = wide.select(columns.row_sum(wide.columns).alias("s")).collect()
    assert sorted(r.s for r in got) == [sum(range(450)) + 450 * i for i in range(3)]


def test_row_sum_edges(rows):
    frame = rows([(1.0, None)], "`a.b` double, c double")
    assert frame.select(columns.row_sum(["a.b"]).alias("s")).collect()[0].s == 1.0
    assert frame.select(columns.row_sum(["a.b", "c"]).alias("s")).collect()[0].s is None
    with pytest.raises(ValueError):
        columns.row_sum([])


SUMMARY = [
    ("working", "male", "young", 2.0, 0.1, 1.0), ("working", "male", "young", 2.5, 0.2, 2.0),
    ("working", "female", "elder", 1.0, 1.0, 1.0), ("not working", "male", "active", 3.0, 0.0, 4.04),
]
AVERAGES = [
    ("not working", "male", "active", 3.0, 0.0, 4.0), ("working", "female", "elder", 1.0, 1.0, 1.0),
    ("working", "male", "young", 2.3, 0.2, 1.5),
]


def test_grouped_forms_agree(rows):
    summary = rows(SUMMARY, S.ROW_SCHEMA)
    averaged = S.grouped_avg(summary)
    assert averaged.columns[3:] == ["avg(primaryNeeds)", "avg(work)", "avg(other)"]
    assert [tuple(r) for r in S.grouped_avg(summary, sort=True).collect()] == AVERAGES
    typed = S.grouped_avg_typed(S.typed(summary))
    assert typed.schema == S.ROW_SCHEMA
    assert sorted(tuple(r) for r in typed.collect()) == AVERAGES
    for view in (None, "summed"):
        unrounded = S.grouped_avg_sql(summary, view)
        assert unrounded.columns == averaged.columns
        assert sorted(tuple(r)[3] for r in unrounded.collect()) == [1.0, 2.25, 3.0]


def test_averages_combine_before_one_shuffle(rows):
    plan = S.grouped_avg(rows(SUMMARY, S.ROW_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan


def test_typed_matches_by_name(rows):
    summary = rows(SUMMARY, S.ROW_SCHEMA)
    mixed = summary.select("other", F.lit(1).alias("extra"), *summary.columns[:5])
    assert sorted(map(tuple, S.typed(mixed).collect())) == sorted(SUMMARY)
    with pytest.raises(ValueError):
        S.typed(summary.drop("work"))


def test_checks_never_multiply(rows):
    left = rows(SUMMARY * 3 + [("working", "male", "old", 9.0, 9.0, 9.0)], S.ROW_SCHEMA)
    right = rows(SUMMARY * 2, S.ROW_SCHEMA)
    checked = S.match_check(left, right, ["working", "sex", "primaryNeeds"]).collect()
    assert sum(r.n_left for r in checked) == left.count() and len(checked) == 5
    assert {(r.n_left, r.n_right, r.flag) for r in checked} == {(3, 2, "OK"), (1, 0, "NOK")}
    flagged = S.rename_and_flag(left, right)
    assert flagged.columns == [*left.columns, "n", *[f"{c}2" for c in left.columns], "flag"]
    assert sum(r.n for r in flagged.collect()) == left.count()
    assert sorted(r.flag for r in flagged.collect()) == ["NOK"] + ["OK"] * 4


def test_totals_equal_long_form(rows):
    frame = rows([respondent(t010101=i, t050101=2 * i, t180201=3, t170101=7) for i in range(20)], SCHEMA)
    totals = {(r.column_name, r.activity_group): r.minutes for r in S.group_totals(frame).collect()}
    long = S.unpivot_groups(frame, "tucaseid")
    assert long.count() == 20 * sum(map(len, GROUPS.values()))
    summed = long.groupBy("column_name", "activity_group").agg(F.sum("minutes").alias("m")).collect()
    assert totals == {(r.column_name, r.activity_group): r.m for r in summed}


def test_filter_and_columns_reach_the_scan(rows, spark, tmp_path):
    path = str(tmp_path / "wide")
    rows([respondent()], SCHEMA).write.parquet(path)
    summary = S.summarize(spark.read.parquet(path)).select("working", "work")
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(telfs,4.0)" in plan
    assert "ReadSchema: struct<telfs:double,t050101:double,t180501:double>" in plan


def test_time_use_from_file(rows, spark, tmp_path):
    path = str(tmp_path / "survey")
    data = [respondent(t010101=60, t050101=30, t020101=6), respondent(t010101=90), respondent(telfs=5.0)]
    rows(data, SCHEMA).write.option("header", True).csv(path)
    assert [tuple(r) for r in jobs.time_use(spark, path).collect()] == [
        ("working", "male", "active", 1.3, 0.3, 0.1)
    ]
