"""The input relations of every job, derived from the star-schema and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.defaults import ARTICLE_MARKER

DOCUMENT_TERMS = ("the", "to", "and", "of", "in", "en", "is", "was", "Scala")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

LINE_PREFIX = "<page> <title>"
LINE_SUFFIX = "</text> </page> "

# Activity column of the survey view and the events whose values it adds up.
ACTIVITIES = {
    "t010101": "event_type = 'click'",
    "t110101": "event_type = 'view'",
    "t050101": "event_type = 'purchase'",
    "t180501": "event_type = 'signup'",
    "t020101": "event_type = 'error'",
    "t180201": "event_id % 2 = 0",
    "t170101": "event_id % 3 = 0",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("title"), "text"
    )


def article_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = articles(spark, folder)
    parts = [F.lit(LINE_PREFIX), "title", F.lit(ARTICLE_MARKER), "text", F.lit(LINE_SUFFIX)]
    return documents.select("doc_id", F.concat(*parts).alias("value"))


def postings(spark: SparkSession, folder: str, score_offset: int = 0) -> DataFrame:
    """Orders as questions and their line items as answers."""
    absent = "cast(NULL AS bigint)"
    asked = table(spark, folder, "orders").selectExpr(
        "1 AS posting_type",
        "o_orderkey AS id",
        f"{absent} AS accepted_answer",
        f"{absent} AS parent_id",
        "cast(o_custkey % 100 AS int) AS score",
        "o_orderpriority AS tags",
    )
    replied = table(spark, folder, "lineitem").selectExpr(
        "2 AS posting_type",
        "l_orderkey * 10 + l_linenumber AS id",
        f"{absent} AS accepted_answer",
        "l_orderkey AS parent_id",
        f"cast(l_quantity AS int) + {score_offset} AS score",
        "cast(NULL AS string) AS tags",
    )
    return asked.unionByName(replied)


def posting_lines(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["posting_type", "id", "accepted_answer", "parent_id", "score", "tags"]
    text = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    return postings(spark, folder).select(F.concat_ws(",", *text).alias("value"))


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """One survey row per user and day, with event values as minutes."""
    minutes = "cast(sum(cast(value AS decimal(18,2))) FILTER (WHERE {}) AS double)"
    days = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    summed = days.agg(
        *[F.expr(f"coalesce({minutes.format(rule)}, 0D) AS {n}") for n, rule in ACTIVITIES.items()]
    )
    return summed.selectExpr(
        "concat_ws('-', cast(user_id AS string), cast(day AS string)) AS tucaseid",
        "cast(user_id * 7 % 90 / 2 + 14 AS double) AS teage",
        "cast(user_id % 5 + 1 AS double) AS telfs",
        "cast(user_id % 2 + 1 AS double) AS tesex",
        *ACTIVITIES,
    )


def fragments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("pos"),
        F.col("l_returnflag").alias("v"),
    )
