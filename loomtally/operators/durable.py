"""Cutting lineage in storage that survives lost executors, and removing what is no longer needed.

Every stored table is entered in a register of its session. A table that replaces another takes
its place in the register and on disk; `release` removes given tables, `cleared` and `clear`
all that a block of code or a session has stored. A result read from a stored table needs it
until it has been read itself, so nothing is removed behind a caller's back.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths of stored tables by application, in the order they were stored.
_stored: dict[str, dict[str, None]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a scratch one only where it is unset and local."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="loomtally-"))
    return context.getCheckpointDir()


def _register(spark: SparkSession) -> dict[str, None]:
    return _stored.setdefault(spark.sparkContext.applicationId, {})


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; what is written there is in the register."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _register(spark)[path] = None
    return path


def _files(spark: SparkSession, path: str) -> tuple:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path, if it is there, and its entry in the register."""
    place, files = _files(spark, path)
    files.delete(place, True)
    _register(spark).pop(path, None)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written to the path to its end."""
    place, files = _files(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def entries(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it isn't there."""
    place, files = _files(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries inside the block go when these end, not when the driver collects garbage.

    For queries whose result is stored: nothing reads their shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def durable(rows: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """The rows read back from a table in the shared folder: nothing upstream runs again.

    The stored table that `replaces` came from is removed once the new one is complete.
    """
    spark = rows.sparkSession
    path = new_path(spark, "rows")
    with _shuffles_removed(spark):
        rows.write.parquet(path)
    if replaces is not None:
        release(replaces)
    return _read(spark, rows, path)


def _read(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    table = spark.read.schema(rows.schema).parquet(path)
    table._stored_at = path
    return table


def durable_at(rows: DataFrame, path: str) -> DataFrame:
    """The rows in a table of a given name, which is only written if it isn't complete yet.

    For work that is taken up again by another session; such a table is in no register.
    """
    spark = rows.sparkSession
    if not is_complete(spark, path):
        rows.write.mode("overwrite").parquet(path)
    return _read(spark, rows, path)


def release(*tables: DataFrame) -> None:
    """Removes stored tables (the frames that `durable` returned); they can't be read any more."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if not isinstance(path, str):
            raise ValueError("only a table that was stored can be released")
        remove(table.sparkSession, path)


def stored_paths(spark: SparkSession) -> list[str]:
    """What the session has stored and not removed."""
    return list(_register(spark))


def clear(spark: SparkSession) -> None:
    """Removes all that the session has stored."""
    for path in stored_paths(spark):
        remove(spark, path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Removes what is stored inside the block when it ends, also by an error."""
    before = set(stored_paths(spark))
    try:
        yield
    finally:
        for path in stored_paths(spark):
            if path not in before:
                remove(spark, path)
