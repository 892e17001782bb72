"""Model-based clustering: thin drivers over Spark ML with one (doc_id, cluster_id) schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import many_kmeans, topic_model
from docloom.operators.assign import assign_nearest, centroids, nearest_in, wss
from docloom.operators.features import tfidf_vectors
from docloom.runtime import forget, materialize, timed


@dataclass
class Clustering:
    """Assignments with what the fit reported. ``centres`` is empty for models without any."""

    assignments: DataFrame
    seconds: float
    centres: list = field(default_factory=list)
    measures: dict = field(default_factory=dict)


def pinned(df: DataFrame, column: str = "vec", partitions: int | None = None) -> DataFrame:
    """(doc_id, features) laid out by id, so that seeded fits repeat; persisted for reuse.

    Spark ML samples partition by partition, hence the layout is part of the seed.
    """
    features = F.col(column)
    if dict(df.dtypes)[column].startswith("array"):
        features = array_to_vector(features)
    rows = df.select("doc_id", features.alias("features"))
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(parts, "doc_id")
        .sortWithinPartitions("doc_id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )


def _labels(model, data: DataFrame) -> DataFrame:
    return materialize(
        model.transform(data).select("doc_id", F.col("prediction").alias("cluster_id")), "clusters"
    )


def _fit_kmeans(data: DataFrame, k: int, seed: int, max_iter: int) -> list:
    """Centres: the k-means|| start of Spark ML, then Lloyd steps until no centre moves, each a scan of stored matrices.

    The number of steps grows with the rows, so what a step costs beside its products decides.
    """
    start = KMeans(k=k, seed=seed, maxIter=0).fit(data).clusterCenters()
    cores = data.sparkSession.sparkContext.defaultParallelism
    dealt = data.select("doc_id", vector_to_array("features").alias("vec")).repartition(cores, "doc_id").sortWithinPartitions("doc_id")
    stored = many_kmeans.matrices(dealt)
    try:
        centres, _ = many_kmeans.lloyd(dealt, {0: np.array([c.tolist() for c in start])}, max_iter, stored)
    finally:
        stored.unpersist()
    return [c.tolist() for c in centres[0]]


def _assigned(data: DataFrame, centres: list) -> DataFrame:
    """(doc_id, vec, cluster_id, distance2) of the nearest centre, written."""
    rows = data.select("doc_id", vector_to_array("features").alias("vec"))
    return materialize(nearest_in(rows, np.arange(len(centres), dtype=np.int32), np.array(centres)), "clusters")


def kmeans(
    df: DataFrame,
    k: int = 610,
    seed: int = 1,
    max_iter: int = 5000,
    column: str = "vec",
    partitions: int | None = None,
) -> Clustering:
    """k-means (k-means|| start)."""
    data = pinned(df, column, partitions)
    try:
        centres, seconds = timed(lambda: _fit_kmeans(data, k, seed, max_iter))
        assigned = _assigned(data, centres)
        return Clustering(assigned.select("doc_id", "cluster_id"), seconds, centres, wss(assigned).first().asDict())
    finally:
        data.unpersist()


def bisecting_kmeans(
    df: DataFrame, k: int = 50, seed: int = 1, column: str = "vec", partitions: int | None = None
) -> Clustering:
    """Bisecting k-means."""
    data = pinned(df, column, partitions)
    try:
        model, seconds = timed(lambda: BisectingKMeans(k=k, seed=seed).fit(data))
        return Clustering(
            _labels(model, data),
            seconds,
            [c.tolist() for c in model.clusterCenters()],
            {"wss": model.summary.trainingCost},
        )
    finally:
        data.unpersist()


def gmm(
    df: DataFrame,
    k: int = 150,
    tol: float = 1.0,
    seed: int = 10,
    max_iter: int = 500,
    column: str = "vec",
    partitions: int | None = None,
) -> Clustering:
    """Gaussian mixture; the cluster is the most probable component."""
    data = pinned(df, column, partitions)
    try:
        fit = GaussianMixture(k=k, tol=tol, seed=seed, maxIter=max_iter)
        model, seconds = timed(lambda: fit.fit(data))
        scored = model.transform(data).select(
            "doc_id",
            F.col("prediction").alias("cluster_id"),
            vector_to_array("probability").alias("probability"),
        )
        return Clustering(
            materialize(scored, "clusters"),
            seconds,
            measures={"log_likelihood": model.summary.logLikelihood},
        )
    finally:
        data.unpersist()


def _texts(df: DataFrame, max_terms: int, min_df: float, seed: int) -> tuple[DataFrame, int]:
    """TF-IDF vectors of (doc_id, tokens) as ``topic_model`` reads them, and the size of the vocabulary."""
    tokens = materialize(df.select("doc_id", "tokens"), "tokens")
    vectors, terms = tfidf_vectors(tokens, max_terms, min_df)
    return topic_model.store(vectors, "features", seed), len(terms)


def lda(
    df: DataFrame,
    k: int = 150,
    max_iter: int = 100,
    seed: int = 1,
    max_terms: int = 5000,
    min_df: float = 5.0,
) -> Clustering:
    """LDA over TF-IDF of (doc_id, tokens); the cluster is the strongest topic, first on a tie."""
    texts, terms = _texts(df, max_terms, min_df, seed)
    model, seconds = timed(lambda: topic_model.fit_many(texts, [k], terms, max_iter, seed)[k])
    found = materialize(topic_model.transform(texts, model), "clusters")
    forget(texts)
    return Clustering(
        found.select("doc_id", "cluster_id", "topics"),
        seconds,
        measures={"log_perplexity": topic_model.log_perplexity(found, model)},
    )


def silhouette(df: DataFrame) -> float:
    """Squared-Euclidean silhouette of (vec, cluster_id): linear in the rows."""
    data = df.select(array_to_vector("vec").alias("features"), F.col("cluster_id").alias("prediction"))
    return ClusteringEvaluator().evaluate(data)


def kmeans_sweep(
    df: DataFrame,
    ks: Sequence[int] = tuple(range(100, 10001, 50)),
    seed: int = 1,
    max_iter: int = 5000,
    column: str = "vec",
    partitions: int | None = None,
) -> DataFrame:
    """(k, wss, silhouette, seconds) per k on one persisted frame."""
    data = pinned(df, column, partitions)
    results = []
    try:
        for k in ks:
            centres, seconds = timed(lambda: _fit_kmeans(data, k, seed, max_iter))
            assigned = _assigned(data, centres)
            results.append((k, wss(assigned).first()["wss"], silhouette(assigned), seconds))
            forget(assigned)
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(
        results, "k int, wss double, silhouette double, seconds double"
    )


def gmm_sweep(
    df: DataFrame,
    ks: Sequence[int] = tuple(range(50, 401, 10)),
    tol: float = 1.0,
    seed: int = 10,
    max_iter: int = 500,
    column: str = "vec",
    partitions: int | None = None,
) -> DataFrame:
    """(k, log_likelihood, seconds, failure) per k on one persisted frame.

    Covariances degenerate when there are few rows per dimension. Such a k says so in
    ``failure`` and has no likelihood; the other values of k are still tried.
    """
    data = pinned(df, column, partitions)
    results = []
    try:
        for k in ks:
            fit = GaussianMixture(k=k, tol=tol, seed=seed, maxIter=max_iter)
            try:
                model, seconds = timed(lambda: fit.fit(data))
            except Exception as error:
                if "MatrixNotSymmetric" not in str(error):
                    raise
                results.append((k, None, None, "the covariance of a component is singular"))
                continue
            results.append((k, model.summary.logLikelihood, seconds, None))
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(results, "k int, log_likelihood double, seconds double, failure string")


def lda_sweep(
    df: DataFrame,
    ks: Sequence[int],
    max_iter: int = 100,
    seed: int = 1,
    max_terms: int = 5000,
    min_df: float = 5.0,
) -> DataFrame:
    """(k, log_perplexity, seconds, best) per k; the lowest log-perplexity is the best. ``seconds`` is the time of all fits."""
    texts, terms = _texts(df, max_terms, min_df, seed)
    models, seconds = timed(lambda: topic_model.fit_many(texts, ks, terms, max_iter, seed))
    results = [(k, topic_model.log_perplexity(topic_model.transform(texts, m), m), seconds) for k, m in models.items()]
    forget(texts)
    lowest = min(results, key=lambda r: (r[1], r[0]))[0] if results else None
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == lowest) for r in results],
        "k int, log_perplexity double, seconds double, best boolean",
    )


def score_centres(df: DataFrame, candidates: dict[int, DataFrame]) -> DataFrame:
    """(k, wss, silhouette) for given sets of centres: the sweep table without a fit."""
    results = []
    for k, centres in candidates.items():
        assigned = materialize(assign_nearest(df, centres), "assigned")
        results.append((k, wss(assigned).first()["wss"], silhouette(assigned)))
    return df.sparkSession.createDataFrame(results, "k int, wss double, silhouette double")


def best_k(sweep: DataFrame) -> DataFrame:
    """The k with the highest silhouette (smallest k on a tie), one row (k, silhouette)."""
    return sweep.agg(
        F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k"),
        F.max("silhouette").alias("silhouette"),
    )


def mean_centres(df: DataFrame) -> DataFrame:
    """Centres of a given clustering: (cluster_id, vec)."""
    return centroids(df).select("cluster_id", "vec")
