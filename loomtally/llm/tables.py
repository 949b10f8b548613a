"""Reading the given tables and cutting lineage."""

from __future__ import annotations

import pickle
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomtally.operators.durable import durable

__all__ = ["SLOTS", "bitmap", "durable", "fresh", "may_hold", "rows_key", "shipped", "small_batches", "table"]

# Bits of a bitmap that travels to the tasks; fixed, however many keys there are.
SLOTS = 1 << 20
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows travel to Python in batches of at most `BATCH_BYTES` from here on in the session.

    Whole texts come in batches of 10,000 rows or 64 MB otherwise, of which each of several
    workers has more than one form at once, and a worker gives little of it back. A session
    that asks for less keeps its setting.
    """
    own = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if own <= 0 or own > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


class Shipped:
    """A broadcast of an object together with its class; loaded once per Python worker."""

    def __init__(self, sent) -> None:
        self.sent = sent

    @property
    def value(self) -> Any:
        # A worker has one broadcast object for all tasks that use it.
        if not hasattr(self.sent, "_loaded"):
            self.sent._loaded = pickle.loads(self.sent.value)
        return self.sent._loaded


def shipped(spark: SparkSession, value: Any) -> Shipped:
    return Shipped(spark.sparkContext.broadcast(cloudpickle.dumps(value)))


def fresh(docs: DataFrame, name: str) -> str:
    """The name, made longer until no column of `docs` has it, in whatever case."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def rows_key(docs: DataFrame) -> Column:
    """A number for (doc_id, text): equal ids with different texts stay apart."""
    return F.xxhash64(F.lit(17), F.col("doc_id"), F.col("text"))


def bitmap(keys: DataFrame, slot: Column):
    """Broadcast bytes with the bits of the keys' slots (0 to `SLOTS` - 1) set."""
    bits = np.zeros(SLOTS, np.uint8)
    bits[keys.select(slot.cast("int").alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)] = 1
    return keys.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())


def may_hold(keys: DataFrame, key: str, column: Column) -> Column:
    """False for numbers that are surely not among the keys.

    Rows are left out before an exchange that a join would drop after it; with ever more
    keys it saves less, and is never wrong.
    """
    shared = bitmap(keys, F.pmod(F.col(key), F.lit(SLOTS)))

    @F.pandas_udf("boolean")
    def held(numbers: pd.Series) -> pd.Series:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8))
        return pd.Series(bits[numbers.to_numpy(np.int64) % SLOTS] == 1)

    return held(column)
