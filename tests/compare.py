"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math
from pathlib import Path

import duckdb

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def open_tables(folder):
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sort_key(row):
    return tuple((value is None, str(value)) for value in row)


def canonical(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(_value(row[i]) for i in order) for row in data]
    return [names[i] for i in order], sorted(picked, key=_sort_key)


def difference(frame, connection, sql):
    """None if both results agree, else a short description."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    types = {name: KINDS.get(kind, kind) for name, kind in frame.dtypes}
    if types != expected_types:
        return f"schema {types} != {expected_types}"
    names, got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    _, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for mine, other in zip(got, want):
        if mine != other:
            return f"{dict(zip(names, mine))} != {dict(zip(names, other))}"
    return None
