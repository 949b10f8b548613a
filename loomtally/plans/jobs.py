"""The end-to-end jobs, from input lines or files to the final report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from loomtally.defaults import (
    CLUSTERS, ETA, MAX_UPDATES, PROGRAMMING_LANGUAGES, TAG_SPREAD,
)
from loomtally.operators import clusters as C, questions as Q, summary as S, terms as T
from loomtally.operators.durable import durable, durable_at, release
from loomtally.sources.articles import read_articles
from loomtally.sources.postings import read_postings
from loomtally.sources.survey import read_survey


def rank_articles(
    spark: SparkSession, path: str, vocabulary: Sequence[str] = PROGRAMMING_LANGUAGES
) -> DataFrame:
    """Article lines to term ranking."""
    return T.rank_combined(read_articles(spark, path), vocabulary)


def cluster_postings(
    postings: DataFrame,
    vocabulary: Sequence[str] = PROGRAMMING_LANGUAGES,
    spread: int = TAG_SPREAD,
    clusters: int = CLUSTERS,
    eta: float = ETA,
    max_updates: int = MAX_UPDATES,
    integer_percent: bool = False,
    journal: str | None = None,
) -> DataFrame:
    """Postings to cluster report.

    The postings are read and shuffled once: starting centres and collapsed points both
    come from the stored vectors, and the updates see the collapsed points only. The vectors
    are removed as soon as the points are stored.

    With a `journal` folder, vectors, points and updates are kept there: run again over the same
    postings after a lost driver, the job takes up where it was. The folder is the caller's.
    """
    scored = Q.tag_vectors(Q.best_answer(postings), vocabulary, spread)
    vectors = durable(scored) if journal is None else durable_at(scored, f"{journal}/vectors")
    centers = C.sample_centers(vectors, len(vocabulary), clusters, spread)
    if journal is None:
        points = C.weighted_points(vectors)
        release(vectors)
    else:
        points = durable_at(C.collapse(vectors), f"{journal}/points")
    found = C.kmeans(points, centers, eta, max_updates, journal)
    return C.cluster_report(points, found.centers, vocabulary, spread, integer_percent)


def cluster_posting_file(spark: SparkSession, path: str) -> DataFrame:
    return cluster_postings(read_postings(spark, path))


def time_use(spark: SparkSession, path: str) -> DataFrame:
    """Survey file to average hours by life period."""
    return S.grouped_avg(S.summarize(read_survey(spark, path)), sort=True)
