"""One named query per operator, over the tables in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.functions import survey as columns
from loomtally.functions.points import Point
from loomtally.operators import (
    clusters as C, fragments as G, layout, posting_lists as P, questions as Q, sampling, summary as S, terms as T,
)
from loomtally.operators.center_tree import assign_from_table
from loomtally.operators.durable import durable, durable_at, new_path, release, remove
from loomtally.operators.medians import group_median, group_median_wide
from loomtally.operators.phrases import phrase_join as phrases_in
from loomtally.operators.pruned import kmeans_pruned as pruned
from loomtally.plans import jobs, views as V
from loomtally.sources.articles import parse_articles
from loomtally.sources.postings import parse_postings
from loomtally.sources.survey import read_survey, read_surveys

Query = Callable[[SparkSession, str], DataFrame]

SPREAD = 50000
CLUSTERS = 15
QUOTA = CLUSTERS // len(V.PRIORITIES)
KNOWN_TAGS = V.PRIORITIES[:4]
DISTANT_POINT = (100000, 20)
NESTED_PARENT = 7
FRACTION = 0.2
SMALL_FRACTION = 0.0004
# The right side of the checks lacks these rows, so that some rows have no partner.
PARTNERS = "age <> 'young'"
ID_SPAN = 256
SEGMENT_SPAN = 3
MET_TERMS = ("the", "of", "and", "in")
LARGE_QUOTA = 5000
POSITION_RANGES = 64
PHRASE_WORDS = (2, 3)
BELOW_ZERO = -25


# --- terms ---------------------------------------------------------------------------

def rank_combined(spark: SparkSession, folder: str) -> DataFrame:
    return T.rank_combined(V.articles(spark, folder), V.DOCUMENT_TERMS)


def rank_terms(spark: SparkSession, folder: str) -> DataFrame:
    return T.rank_terms(V.articles(spark, folder), V.DOCUMENT_TERMS)


def inverted_index(spark: SparkSession, folder: str) -> DataFrame:
    return T.inverted_index(V.articles(spark, folder), V.DOCUMENT_TERMS, "doc_id")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return T.index_blocks(inverted_index(spark, folder), "doc_id", ID_SPAN)


def index_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).select(
        "term", "block", F.size("articles").alias("n_articles"),
        F.array_join("articles", ",").alias("articles"),
    )


def _lists(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "lists")
    P.store(P.posting_lists(inverted_index(spark, folder), "doc_id", ID_SPAN), path)
    return P.stored(spark, path)


def posting_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _lists(spark, folder).select("term", "block", "lo", "hi", "n", "mentions")


def posting_intersect(spark: SparkSession, folder: str) -> DataFrame:
    return P.intersect(_lists(spark, folder), MET_TERMS).select(F.col("id").alias("doc_id"))


def rank_from_lists(spark: SparkSession, folder: str) -> DataFrame:
    return P.rank_from_lists(_lists(spark, folder))


def rank_from_index(spark: SparkSession, folder: str) -> DataFrame:
    return T.rank_from_index(_blocks(spark, folder))


def range_layout(spark: SparkSession, folder: str) -> DataFrame:
    return layout.range_layout(inverted_index(spark, folder), 10, "term", "doc_id")


def ordered_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.table(spark, folder, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    return layout.ordered_positions(rows, "l_returnflag", "l_quantity", ranges=POSITION_RANGES)


def mention_count(spark: SparkSession, folder: str) -> DataFrame:
    return T.count_mentions(V.articles(spark, folder), "the")


def mention_filter(spark: SparkSession, folder: str) -> DataFrame:
    return T.mentioning(V.articles(spark, folder), "the")


def mention_join(spark: SparkSession, folder: str) -> DataFrame:
    words = V.table(spark, folder, "benchmark").select(F.explode(F.split("text", " ")).alias("term"))
    return T.mention_join(V.articles(spark, folder), words, "doc_id")


def phrase_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every run of two or three words that a benchmark item holds, in every document."""
    words = F.split("text", " ")
    runs = [
        V.table(spark, folder, "benchmark").select(words.alias("w")).where(F.size("w") >= m)
        .select(F.explode(F.expr(f"transform(sequence(1, size(w) - {m - 1}), i -> array_join(slice(w, i, {m}), ' '))")).alias("term"))
        for m in PHRASE_WORDS
    ]
    return phrases_in(V.articles(spark, folder), runs[0].unionByName(runs[1]), "doc_id")


def top_terms(spark: SparkSession, folder: str) -> DataFrame:
    return T.top_terms(T.term_counts(V.articles(spark, folder), V.DOCUMENT_TERMS), 3)


# --- parsing and files ---------------------------------------------------------------

def article_parse(spark: SparkSession, folder: str) -> DataFrame:
    return parse_articles(V.article_lines(spark, folder))


def posting_parse(spark: SparkSession, folder: str) -> DataFrame:
    return parse_postings(V.posting_lines(spark, folder), id_type="bigint")


def survey_file(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "survey")
    V.activity(spark, folder).write.option("header", True).csv(path)
    return _plain(S.grouped_avg(S.summarize(read_survey(spark, path))))


def survey_files_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the rows in files whose columns stand the other way round."""
    path, rows = new_path(spark, "surveys"), V.activity(spark, folder)
    half = F.pmod(F.xxhash64("tucaseid"), F.lit(2)) == 0
    rows.where(half).write.option("header", True).csv(path)
    turned = rows.where(~half).select("tucaseid", *reversed(rows.columns[1:]))
    turned.write.mode("append").option("header", True).csv(path)
    return _plain(S.grouped_avg(S.summarize(read_surveys(spark, path, rows.columns))))


# --- questions -----------------------------------------------------------------------

def qa_join(spark: SparkSession, folder: str) -> DataFrame:
    return Q.qa_pairs(V.postings(spark, folder)).select(
        "qid", F.col("question.tags").alias("tags"), F.col("question.score").alias("question_score"),
        F.col("answer.id").alias("answer_id"), F.col("answer.score").alias("answer_score"),
    )


def _block_summary(grouped: DataFrame) -> DataFrame:
    ids = F.sort_array(F.transform("pairs", lambda pair: pair["answer"]["id"]))
    return grouped.select(
        "qid", "block", F.size("pairs").alias("n_pairs"), F.array_join(ids, ",").alias("answers")
    )


def qa_grouped(spark: SparkSession, folder: str) -> DataFrame:
    return _block_summary(Q.qa_grouped(V.postings(spark, folder)))


def nested_exists(spark: SparkSession, folder: str) -> DataFrame:
    return _block_summary(Q.grouped_with_answer_to(V.postings(spark, folder), NESTED_PARENT))


def best_answer(spark: SparkSession, folder: str) -> DataFrame:
    return Q.best_answer(V.postings(spark, folder, BELOW_ZERO))


def tag_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return Q.tag_vectors(Q.best_answer(V.postings(spark, folder)), KNOWN_TAGS, SPREAD)


# --- clusters ------------------------------------------------------------------------

def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return Q.tag_vectors(Q.best_answer(V.postings(spark, folder)), V.PRIORITIES, SPREAD)


def _start(spark: SparkSession, folder: str) -> tuple[DataFrame, list[Point]]:
    """Stored vectors and the centres drawn from them."""
    vectors = durable(_vectors(spark, folder))
    return vectors, C.sample_centers(vectors, len(V.PRIORITIES), CLUSTERS, SPREAD)


def nearest_center(spark: SparkSession, folder: str) -> DataFrame:
    return C.assign(*_start(spark, folder))


def nearest_center_table(spark: SparkSession, folder: str) -> DataFrame:
    """Each order's nearest part, both placed on a grid; the parts are the centres."""
    centers = V.table(spark, folder, "part").select(
        F.col("p_partkey").alias("cluster"), F.col("p_size").cast("int").alias("x"), F.expr("cast(p_retailprice as int) % 100").alias("y")
    )
    points = V.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr("cast(o_custkey % 53 as int)").alias("x"), F.expr("cast(o_totalprice as int) % 103").alias("y")
    )
    return assign_from_table(points, centers)


def point_distance(spark: SparkSession, folder: str) -> DataFrame:
    return C.with_distance(_vectors(spark, folder), DISTANT_POINT)


def kmeans_step(spark: SparkSession, folder: str) -> DataFrame:
    vectors, centers = _start(spark, folder)
    return C.update_step(C.collapse(vectors), centers)


def centroid_shift(spark: SparkSession, folder: str) -> DataFrame:
    vectors, centers = _start(spark, folder)
    before = C.centers_frame(spark, centers)
    return C.centroid_shift(before, C.update_step(C.collapse(vectors), centers))


def _clustered(spark: SparkSession, folder: str) -> tuple[DataFrame, C.Clustering]:
    vectors, centers = _start(spark, folder)
    points = C.weighted_points(vectors)
    release(vectors)
    return points, C.kmeans(points, centers)


def kmeans(spark: SparkSession, folder: str) -> DataFrame:
    points, found = _clustered(spark, folder)
    release(points)
    return C.centers_frame(spark, found.centers).withColumn("updates", F.lit(found.updates))


def kmeans_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """Stopped after two updates, then taken up from its journal."""
    vectors, centers = _start(spark, folder)
    journal = new_path(spark, "journal")
    points = durable_at(C.collapse(vectors), f"{journal}/points")
    C.kmeans(points, centers, max_updates=2, journal=journal)
    found = C.kmeans(durable_at(C.collapse(vectors), f"{journal}/points"), centers, journal=journal)
    release(vectors)
    remove(spark, journal)
    return C.centers_frame(spark, found.centers).withColumn("updates", F.lit(found.updates))


def kmeans_pruned(spark: SparkSession, folder: str) -> DataFrame:
    vectors, centers = _start(spark, folder)
    found = pruned(C.collapse(vectors), centers).clustering
    release(vectors)
    return C.centers_frame(spark, found.centers).withColumn("updates", F.lit(found.updates))


def cluster_histogram(spark: SparkSession, folder: str) -> DataFrame:
    points, found = _clustered(spark, folder)
    return C.cluster_histogram(points, found.centers, SPREAD)


def cluster_report(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.cluster_postings(V.postings(spark, folder), V.PRIORITIES, SPREAD, CLUSTERS)


def cluster_report_intpct(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.cluster_postings(
        V.postings(spark, folder), V.PRIORITIES, SPREAD, CLUSTERS, integer_percent=True
    )


def group_median_query(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int") + BELOW_ZERO
    rows = V.table(spark, folder, "lineitem").select("l_suppkey", quantity.alias("quantity"))
    return group_median(rows, "l_suppkey", "quantity")


def group_median_wide_query(spark: SparkSession, folder: str) -> DataFrame:
    return group_median_wide(V.table(spark, folder, "lineitem"), "l_suppkey", "l_extendedprice")


# --- samples -------------------------------------------------------------------------

def fixed_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.fixed_sample(_vectors(spark, folder), CLUSTERS)


def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_sample(_vectors(spark, folder), "x", QUOTA)


def stratified_sample_large(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_returnflag", "l_quantity"
    )
    return sampling.stratified_sample(rows, "l_returnflag", LARGE_QUOTA, seed=LARGE_QUOTA, short="keep")


def fraction_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.fraction_sample(_vectors(spark, folder), FRACTION, "id")


def fraction_sample_small(spark: SparkSession, folder: str) -> DataFrame:
    answers = V.postings(spark, folder).where(F.col("posting_type") == 2).select("id")
    return sampling.fraction_sample(answers, SMALL_FRACTION, "id")


# --- survey --------------------------------------------------------------------------

def _summary(spark: SparkSession, folder: str) -> DataFrame:
    return S.summarize(V.activity(spark, folder))


def _plain(averages: DataFrame) -> DataFrame:
    return averages.toDF(*S.KEYS, *S.MEASURES)


def column_groups(spark: SparkSession, folder: str) -> DataFrame:
    return S.group_totals(V.activity(spark, folder)).withColumn("minutes", F.round("minutes", 2))


def unpivot_groups(spark: SparkSession, folder: str) -> DataFrame:
    return S.unpivot_groups(V.activity(spark, folder), "tucaseid")


def bucketing(spark: SparkSession, folder: str) -> DataFrame:
    return V.activity(spark, folder).select(
        "tucaseid",
        columns.working_status(F.col("telfs")).alias("working"),
        columns.sex(F.col("tesex")).alias("sex"),
        columns.age_band(F.col("teage")).alias("age"),
    )


def row_sum(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.activity(spark, folder)
    groups = columns.column_groups(rows.columns)
    sums = [F.round(columns.hours(groups[m]), 6).alias(m) for m in S.MEASURES]
    return rows.select("tucaseid", *sums)


def wide_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder).withColumns({m: F.round(m, 6) for m in S.MEASURES})


def typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    summary = wide_summary(spark, folder)
    shuffled = summary.select(*reversed(summary.columns), F.lit("unused").alias("extra"))
    return S.typed(shuffled)


def left_join_check(spark: SparkSession, folder: str) -> DataFrame:
    summary = wide_summary(spark, folder)
    return S.match_check(summary, S.typed(summary).where(PARTNERS), ["working", "sex", "primaryNeeds"])


def rename_flag(spark: SparkSession, folder: str) -> DataFrame:
    summary = wide_summary(spark, folder)
    return S.rename_and_flag(summary, S.typed(summary).where(PARTNERS))


def grouped_avg(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(S.grouped_avg(_summary(spark, folder)))


def grouped_avg_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(S.grouped_avg(_summary(spark, folder), sort=True))


def grouped_avg_sql(spark: SparkSession, folder: str) -> DataFrame:
    unrounded = _plain(S.grouped_avg_sql(_summary(spark, folder)))
    return unrounded.withColumns({m: F.round(m, 6) for m in S.MEASURES})


def grouped_avg_typed(spark: SparkSession, folder: str) -> DataFrame:
    return S.grouped_avg_typed(S.typed(_summary(spark, folder)))


# --- fragments -----------------------------------------------------------------------

def keyed_concat(spark: SparkSession, folder: str) -> DataFrame:
    return G.keyed_concat(V.fragments(spark, folder), "k", "pos", "v")


def keyed_concat_segments(spark: SparkSession, folder: str) -> DataFrame:
    return G.segments(V.fragments(spark, folder), "k", "pos", "v", SEGMENT_SPAN)


def group_fold(spark: SparkSession, folder: str) -> DataFrame:
    return G.group_fold(V.fragments(spark, folder), "k", "pos", "v")


def udaf_concat(spark: SparkSession, folder: str) -> DataFrame:
    return G.aggregate_with(V.fragments(spark, folder), "k", "pos", "v")


def nested_struct(spark: SparkSession, folder: str) -> DataFrame:
    nested = V.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("_1"), F.col("c_mktsegment").alias("_2")).alias("details"),
    )
    return nested.select("id", F.col("details._1").alias("name"), F.col("details._2").alias("segment"))


QUERIES: dict[str, Query] = {
    "rank_combined": rank_combined,
    "rank_terms": rank_terms,
    "rank_from_index": rank_from_index,
    "posting_blocks": posting_blocks,
    "posting_intersect": posting_intersect,
    "rank_from_lists": rank_from_lists,
    "inverted_index": inverted_index,
    "index_blocks": index_blocks,
    "range_layout": range_layout,
    "ordered_positions": ordered_positions,
    "mention_count": mention_count,
    "mention_filter": mention_filter,
    "mention_join": mention_join,
    "phrase_join": phrase_join,
    "top_terms": top_terms,
    "article_parse": article_parse,
    "posting_parse": posting_parse,
    "survey_file": survey_file,
    "survey_files_mixed": survey_files_mixed,
    "qa_join": qa_join,
    "qa_grouped": qa_grouped,
    "nested_exists": nested_exists,
    "best_answer": best_answer,
    "tag_vectors": tag_vectors,
    "nearest_center": nearest_center,
    "nearest_center_table": nearest_center_table,
    "point_distance": point_distance,
    "kmeans_step": kmeans_step,
    "centroid_shift": centroid_shift,
    "kmeans": kmeans,
    "kmeans_resumed": kmeans_resumed,
    "kmeans_pruned": kmeans_pruned,
    "cluster_histogram": cluster_histogram,
    "group_median": group_median_query,
    "group_median_wide": group_median_wide_query,
    "cluster_report": cluster_report,
    "cluster_report_intpct": cluster_report_intpct,
    "fixed_sample": fixed_sample,
    "stratified_sample": stratified_sample,
    "stratified_sample_large": stratified_sample_large,
    "fraction_sample": fraction_sample,
    "fraction_sample_small": fraction_sample_small,
    "column_groups": column_groups,
    "unpivot_groups": unpivot_groups,
    "bucketing": bucketing,
    "row_sum": row_sum,
    "wide_summary": wide_summary,
    "typed_projection": typed_projection,
    "rename_flag": rename_flag,
    "left_join_check": left_join_check,
    "grouped_avg": grouped_avg,
    "grouped_avg_sql": grouped_avg_sql,
    "grouped_avg_typed": grouped_avg_typed,
    "grouped_avg_sorted": grouped_avg_sorted,
    "keyed_concat": keyed_concat,
    "keyed_concat_segments": keyed_concat_segments,
    "group_fold": group_fold,
    "udaf_concat": udaf_concat,
    "nested_struct": nested_struct,
}
