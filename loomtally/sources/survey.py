"""Wide survey tables from CSV: an identifier followed by numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loomtally.sources.strict import keep_valid


def survey_schema(names: Sequence[str]) -> T.StructType:
    """First column a string, every other one a double, none of them nullable."""
    first, *rest = names
    return T.StructType(
        [T.StructField(first, T.StringType(), False)]
        + [T.StructField(name, T.DoubleType(), False) for name in rest]
    )


def require_non_null(rows: DataFrame, mode: str = "fail") -> DataFrame:
    """Enforce what a file scan does not: no field may be missing."""
    missing = F.array(*[F.col(f"`{c}`").isNull() for c in rows.columns])
    complete = ~F.array_contains(missing, True)
    return keep_valid(rows, complete, F.lit("survey row with a missing value"), mode)


def read_survey(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    """Rows under the header's names; the header is skipped in every file.

    A short row, a cell that is no number and an empty cell are malformed. The header line
    is the only data that reaches the driver.
    """
    header = spark.read.text(path).first()
    if header is None:
        raise ValueError(f"no header line in {path}")
    schema = survey_schema(header[0].split(","))
    return require_non_null(_reader(spark, schema, mode).csv(path), mode)


def _reader(spark: SparkSession, schema: T.StructType, mode: str):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", "")
        .option("mode", "FAILFAST" if mode == "fail" else "DROPMALFORMED")
    )


def header_lines(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    """The first line of every file; files are listed, and packed ones unpacked, as Spark does."""
    hadoop, java = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jvm.java
    settings, found = spark.sparkContext._jsc.hadoopConfiguration(), {}
    codecs = hadoop.io.compress.CompressionCodecFactory(settings)
    for name in sorted(spark.read.text(path).inputFiles()):
        place = hadoop.fs.Path(java.net.URI(name))
        stream, codec = place.getFileSystem(settings).open(place), codecs.getCodec(place)
        lines = java.io.BufferedReader(java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8"))
        line = lines.readLine()
        lines.close()
        if line is not None:
            found[name] = line
    return found


def header_fingerprint(names: Sequence[str]) -> str:
    """Stands for a header: files with equal ones are read by one scan."""
    return hashlib.sha256("\n".join(names).encode()).hexdigest()


def read_surveys(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str] | None = None, mode: str = "fail"
) -> DataFrame:
    """Rows of files whose columns stand in different orders, under `names`.

    Each file's header decides where its columns are. Files with the same header are one scan, and
    the scans are united by name. Without `names`, those of the first file (by its path) hold.
    A file that lacks one of them, or names a column twice, is an error; other columns are
    left out. An empty file has no rows. Malformed rows as for `read_survey`. The headers, a
    line a file, are all that reaches the driver.
    """
    headers = {file: line.split(",") for file, line in header_lines(spark, path).items()}
    if not headers:
        raise ValueError(f"no header line in {path}")
    names = list(names or next(iter(headers.values())))
    layouts: dict[str, list[str]] = {}
    for file, header in headers.items():
        missing = [name for name in names if header.count(name) != 1]
        if missing:
            raise ValueError(f"{file} must have the column {missing[0]} once")
        if len(set(header)) != len(header):
            raise ValueError(f"{file} names a column twice")
        layouts.setdefault(header_fingerprint(header), []).append(file)
    schema, parts = survey_schema(names), []
    kinds = {field.name: field.dataType for field in schema}
    for files in layouts.values():
        # Columns that nobody asked for are read as text, whatever is in them.
        own = T.StructType([T.StructField(n, kinds.get(n, T.StringType()), True) for n in headers[files[0]]])
        parts.append(_reader(spark, own, mode).csv(files).select(*[f"`{n}`" for n in names]))
    return require_non_null(reduce(DataFrame.unionByName, parts), mode)
