"""Many k in one scan against separate computations."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans

from docloom.functions import kernels
from docloom.operators import cluster, many_kmeans


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(c, 0.6, size=(60, 4)) for c in rng.normal(0, 5, size=(9, 4))])
    return x[rng.permutation(len(x))]


def near(x, centres):
    gaps = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    return gaps.argmin(axis=1), gaps.min(axis=1).sum()


def silhouette(x, label):
    gaps = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    out = []
    for i, c in enumerate(label):
        own = label == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a, b = gaps[i][own].sum() / (own.sum() - 1), min(gaps[i][label == o].mean() for o in set(label) if o != c)
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_centres_are_fixed_points(spark, vectors, blobs):
    centres, turns = many_kmeans.fit_many(vectors(spark, blobs), [2, 9, 20])
    for k, c in centres.items():
        assert len(c) == k and 1 <= turns[k] < 200
        label, _ = near(blobs, c)
        for j in range(k):
            if (label == j).any():
                assert np.abs(blobs[label == j].mean(axis=0) - c[j]).max() < 1e-3


def test_sweep_is_as_good_as_separate_fits(spark, vectors, blobs):
    df, ks = vectors(spark, blobs), [2, 5, 9, 14]
    rows = {r["k"]: r for r in many_kmeans.kmeans_sweep(df, ks).collect()}
    centres, _ = many_kmeans.fit_many(df, ks)
    assert sorted(rows) == ks
    for k in ks:
        label, wss = near(blobs, centres[k])
        assert rows[k]["wss"] == pytest.approx(wss)
        assert rows[k]["silhouette"] == pytest.approx(silhouette(blobs, label))
    # nine well separated blobs: the right k finds them, and no worse than a separate fit
    assert rows[9]["wss"] <= 1.01 * cluster.kmeans(df, k=9).measures["wss"]
    assert cluster.best_k(many_kmeans.kmeans_sweep(df, ks)).first()["k"] == 9


def test_more_clusters_than_vectors_and_one_cluster(spark, vectors):
    x = np.repeat(np.arange(6.0)[:, None], 5, axis=0) @ np.ones((1, 2))
    rows = {r["k"]: r for r in many_kmeans.kmeans_sweep(vectors(spark, x), [1, 50]).collect()}
    assert rows[1]["silhouette"] is None and rows[1]["wss"] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert rows[50]["wss"] == pytest.approx(0.0)


def test_too_many_centres(spark, vectors, blobs):
    with pytest.raises(ValueError):
        many_kmeans.fit_many(vectors(spark, blobs), [10**7])


def test_a_table_of_one_part_is_dealt_over_the_cores(spark, vectors, blobs):
    dealt = many_kmeans._dealt(vectors(spark, blobs).coalesce(1))
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and dealt.count() == len(blobs)


def test_nearest_is_exact_in_single_precision():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 5))
    for scale, offset in ((1.0, 0.0), (1e18, 0.0), (1e-18, 0.0), (1.0, 1e4), (1e-6, 1.0)):
        y = x * scale + offset
        c = y[rng.permutation(700)[:60]] + scale * 1e-9
        c[7] = c[3]
        gaps = ((y[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert np.array_equal(kernels.nearest_index(y, c), gaps.argmin(axis=1))


def test_a_step_is_one_stage_and_both_routes_agree(spark, vectors, blobs, monkeypatch):
    """A fit of one k takes many steps, and each must be one small job; the route of large sums has the same result."""
    df, asked = vectors(spark, blobs), []
    plain = many_kmeans._shuffled
    monkeypatch.setattr(many_kmeans, "_shuffled", lambda *a: asked.append(1) or plain(*a))
    direct = cluster.kmeans(df, k=12)
    assert not asked
    monkeypatch.setattr(many_kmeans, "DIRECT_BYTES", 0)
    shuffled = cluster.kmeans(df, k=12)
    assert asked
    assert np.allclose(direct.centres, shuffled.centres) and direct.measures["wss"] == pytest.approx(shuffled.measures["wss"])
    assert sorted(direct.assignments.collect()) == sorted(shuffled.assignments.collect())


def test_kmeans_is_the_fit_of_spark_ml(spark, vectors, blobs):
    df = vectors(spark, blobs)
    data = cluster.pinned(df, partitions=3)
    model = KMeans(k=20, seed=1, maxIter=5000).fit(data)
    got = cluster.kmeans(df, k=20, partitions=3)
    assert np.allclose(got.centres, [c.tolist() for c in model.clusterCenters()])
    wanted = {r["doc_id"]: r["prediction"] for r in model.transform(data).collect()}
    assert {r["doc_id"]: r["cluster_id"] for r in got.assignments.collect()} == wanted
    data.unpersist()
