"""A journal of an iteration, from which another session takes it up again.

Each step is a small table in the journal's folder, complete or not there: Spark marks a table
when its last file is in place. The step before is removed after that, so the folder holds one
step, or two if the driver was lost in between. The fingerprint of the iteration's input is in
every row; a journal of other input is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from loomtally.operators.durable import entries, is_complete, remove

STEP = "step-"


class Journal:
    def __init__(self, spark: SparkSession, folder: str, fingerprint: str) -> None:
        self.spark, self.folder, self.fingerprint = spark, folder.rstrip("/"), fingerprint

    def _path(self, step: int) -> str:
        return f"{self.folder}/{STEP}{step:09d}"

    def _steps(self) -> list[int]:
        return [int(name[len(STEP):]) for name in entries(self.spark, self.folder) if name.startswith(STEP)]

    def latest(self) -> tuple[int, list[Row]] | None:
        """The last complete step and its rows; None in a new journal."""
        for step in reversed(self._steps()):
            if is_complete(self.spark, self._path(step)):
                rows = self.spark.read.parquet(self._path(step)).collect()
                if any(row["_fingerprint"] != self.fingerprint for row in rows):
                    raise ValueError(f"{self.folder} is the journal of another run")
                return step, rows
        return None

    def record(self, step: int, rows: DataFrame) -> None:
        """Writes a step's rows (a handful) and removes the steps before it."""
        done = rows.withColumn("_fingerprint", F.lit(self.fingerprint))
        done.coalesce(1).write.mode("overwrite").parquet(self._path(step))
        for earlier in self._steps():
            if earlier < step:
                remove(self.spark, self._path(earlier))
