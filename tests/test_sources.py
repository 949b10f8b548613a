"""Readers: positional articles, comma-separated postings, wide survey files."""

import pytest
from pyspark.sql import types as T

from loomtally.sources.articles import parse_articles, read_articles
from loomtally.sources.postings import parse_postings, read_postings
from loomtally.sources.survey import read_survey, read_surveys, survey_schema

P, M, S = "<page> <title>", "</title><text>", "</text> </page> "


def tuples(frame):
    return [tuple(row) for row in frame.collect()]


def lines(rows, *values):
    return rows([(v,) for v in values], "value string", 1)


@pytest.mark.parametrize(
    "line, title, text",
    [
        (f"{P}Spark{M}a fast engine{S}", "Spark", "a fast engine"),
        (f"{P}{M}text{S}", "", "text"),
        (f"{P}title{M}{S}", "title", ""),
        (f"{P}t{M}one{M}two{S}", "t", f"one{M}two"),
        ("x" * 14 + f"é{M}ü" + "y" * 16, "é", "ü"),
    ],
)
def test_article_lines(rows, line, title, text):
    assert tuples(parse_articles(lines(rows, line))) == [(title, text)]


@pytest.mark.parametrize(
    "line", ["no marker at all, but long enough for everything", f"short{M}text{S}", f"{P}t{M}cut", None]
)
def test_malformed_articles(rows, line):
    good = f"{P}a{M}b{S}"
    with pytest.raises(Exception, match="malformed article"):
        parse_articles(lines(rows, good, line)).count()
    assert tuples(parse_articles(lines(rows, good, line), mode="drop")) == [("a", "b")]


def test_article_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text(f"{P}a{M}b{S}\n{P}c{M}d{S}\n")
    assert sorted(tuples(read_articles(spark, str(tmp_path)))) == [("a", "b"), ("c", "d")]


@pytest.mark.parametrize(
    "line, posting",
    [
        ("1,10,12,,7,Java", (1, 10, 12, None, 7, "Java")),
        ("1,11,,,0,Erlang", (1, 11, None, None, 0, "Erlang")),
        ("1,13,,,2,", (1, 13, None, None, 2, None)),
        ("2,12,,10,5", (2, 12, None, 10, 5, None)),
        ("2,14,,10,-3,", (2, 14, None, 10, -3, None)),
        ("2,15,,,4", (2, 15, None, None, 4, None)),
        ("3,16,,,+1,a,b,c", (3, 16, None, None, 1, "a")),
        ("1,17,,,1,,b", (1, 17, None, None, 1, "")),
    ],
)
@pytest.mark.parametrize("mode", ["fail", "drop"])
def test_posting_lines(rows, line, posting, mode):
    assert tuples(parse_postings(lines(rows, line), mode)) == [posting]


@pytest.mark.parametrize(
    "line",
    ["1,x,,,1", "1,17,,", "1,17,y,,1", "1,17,, 3,1", "1,99999999999,,,1", "1,17,,,1.5", "", ",,,,", None],
)
def test_malformed_postings(rows, line):
    good = "2,12,,10,5"
    with pytest.raises(Exception, match="malformed"):
        parse_postings(lines(rows, good, line)).collect()
    assert tuples(parse_postings(lines(rows, good, line), "drop")) == [(2, 12, None, 10, 5, None)]


def test_posting_file_with_large_ids(spark, tmp_path):
    (tmp_path / "p.csv").write_text("1,99999999999,,,1,Java\n")
    frame = read_postings(spark, str(tmp_path), id_type="bigint")
    assert tuples(frame) == [(1, 99999999999, None, None, 1, "Java")]


def test_unknown_mode(rows):
    with pytest.raises(ValueError):
        parse_postings(lines(rows, "1,1,,,1"), "ignore")
    with pytest.raises(ValueError):
        parse_articles(lines(rows, ""), "ignore")


def test_survey_schema():
    schema = survey_schema(["id", "a", "b"])
    assert [f.dataType for f in schema] == [T.StringType(), T.DoubleType(), T.DoubleType()]
    assert not any(f.nullable for f in schema)


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_survey_files_each_with_header(spark, tmp_path):
    path = write(tmp_path, a='id,t01,t02\n"x",1,3\n', b="id,t01,t02\ny,4.5,5\n")
    frame = read_survey(spark, path)
    assert frame.columns == ["id", "t01", "t02"]
    assert sorted(tuples(frame)) == [('"x"', 1.0, 3.0), ("y", 4.5, 5.0)]


@pytest.mark.parametrize("row", ["x,1", "x,1,", "x,,1", "x,a,1", "x,1,2,3"])
def test_malformed_survey_rows(spark, tmp_path, row):
    path = write(tmp_path, a=f"id,t01,t02\nok,1,2\n{row}\n")
    with pytest.raises(Exception):
        read_survey(spark, path).select("id").collect()
    assert tuples(read_survey(spark, path, "drop")) == [("ok", 1.0, 2.0)]


def test_survey_without_header(spark, tmp_path):
    with pytest.raises(ValueError):
        read_survey(spark, write(tmp_path, a=""))


# --- surveys with differing headers --------------------------------------------------


def write_surveys(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_columns_stand_where_their_header_says(spark, tmp_path):
    path = write_surveys(tmp_path / "s", a="id,x,y\nr1,1,2\nr2,3,4\n", b="y,id,more,x\n20,r3,text,10\n", c="id,x,y\nr4,5,6\n", d="")
    got = read_surveys(spark, path)
    assert got.columns == ["id", "x", "y"]
    assert sorted(map(tuple, got.collect())) == [("r1", 1.0, 2.0), ("r2", 3.0, 4.0), ("r3", 10.0, 20.0), ("r4", 5.0, 6.0)]
    assert sorted(map(tuple, read_surveys(spark, path, ["id", "y"]).collect())) == [("r1", 2.0), ("r2", 4.0), ("r3", 20.0), ("r4", 6.0)]
    # One scan for each of the two headers, however many files have it.
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_missing_and_repeated_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="b.csv must have the column y once"):
        read_surveys(spark, write_surveys(tmp_path / "s", a="id,x,y\nr,1,2\n", b="id,x\nr,1\n"))
    with pytest.raises(ValueError, match="must have the column x once"):
        read_surveys(spark, write_surveys(tmp_path / "t", a="id,x,y,x\nr,1,2,3\n"), ["id", "x"])
    with pytest.raises(ValueError, match="names a column twice"):
        read_surveys(spark, write_surveys(tmp_path / "u", a="id,x,z,z\nr,1,2,3\n"), ["id", "x"])
    with pytest.raises(ValueError, match="no header line"):
        read_surveys(spark, write_surveys(tmp_path / "v", a=""))


def test_malformed_rows_of_any_layout(spark, tmp_path):
    path = write_surveys(tmp_path / "s", a="id,x,y\nr1,1,2\n", b="y,x,id\nbad,1,r2\n7,8,r3\n,9,r4\n")
    with pytest.raises(Exception):
        read_surveys(spark, path).collect()
    assert sorted(r.id for r in read_surveys(spark, path, mode="drop").collect()) == ["r1", "r3"]


def test_packed_files(spark, tmp_path):
    import gzip

    path = write_surveys(tmp_path / "s", a="id,x,y\nr1,1,2\n")
    (tmp_path / "s" / "b.csv.gz").write_bytes(gzip.compress(b"y,id,x\n4,r2,3\n"))
    assert sorted(map(tuple, read_surveys(spark, path).collect())) == [("r1", 1.0, 2.0), ("r2", 3.0, 4.0)]
