"""Blocked pair work and DBSCAN against brute force, for every way of cutting the blocks."""

import numpy as np
import pytest

from docloom.functions import kernels
from docloom.operators import blocks, components, density, density_forest

CUTS = [(None, 2048), (1, 7), (5, 9), (12, 40)]


def gaps(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def brute_dbscan(x, eps, min_samples):
    near = gaps(x) <= eps
    core = near.sum(axis=1) >= min_samples
    label = np.full(len(x), -1)
    number = 0
    for seed in range(len(x)):
        if not core[seed] or label[seed] >= 0:
            continue
        stack = [seed]
        label[seed] = number
        while stack:
            for j in np.nonzero(near[stack.pop()] & core)[0]:
                if label[j] < 0:
                    label[j] = number
                    stack.append(j)
        number += 1
    for i in np.nonzero(~core)[0]:
        reach = label[near[i] & core]
        if len(reach):
            label[i] = reach.min()
    return label


@pytest.fixture(scope="module")
def cloud():
    """Clumps, a chain, copies of one point and noise."""
    rng = np.random.default_rng(5)
    clumps = [rng.normal(c, 0.25, size=(40, 3)) for c in ((0, 0, 0), (3, 0, 0), (0, 3, 3))]
    chain = np.column_stack([np.linspace(-6, -3, 25), np.zeros(25), np.zeros(25)])
    copies = np.repeat([[1.5, 0.1, 0.0]], 30, axis=0)
    noise = rng.uniform(-8, 8, size=(40, 3))
    x = np.vstack([*clumps, chain, copies, noise])
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize(
    "anchors,block_rows,eps,min_samples", [(*cut, 0.5, 5) for cut in CUTS] + [(12, 40, 0.9, 12)]
)
def test_dbscan(spark, vectors, cloud, anchors, block_rows, eps, min_samples):
    got = density.dbscan(vectors(spark, cloud), eps, min_samples, anchors, block_rows).collect()
    label = dict(got)
    assert len(got) == len(cloud)
    assert [label[i] for i in range(len(cloud))] == brute_dbscan(cloud, eps, min_samples).tolist()


def test_dbscan_border_point_joins_the_lower_cluster_and_single_cores(spark, vectors):
    x = np.array([[0.0], [0.1], [0.2], [1.1], [2.0], [2.1], [2.2], [9.0]])
    df = vectors(spark, x)
    assert [c for _, c in sorted(density.dbscan(df, 0.9, 4).collect())] == brute_dbscan(x, 0.9, 4).tolist()
    assert [c for _, c in sorted(density.dbscan(df, 0.01, 1).collect())] == list(range(8))
    assert {c for _, c in density.dbscan(df, 0.5, 50).collect()} == {-1}
    # default: 2 x dimension - 1 = 1 sample, every point is a core point
    assert density.dbscan(df, 0.01).where("cluster_id < 0").count() == 0


@pytest.mark.parametrize("anchors,block_rows", CUTS)
def test_epsilon_join(spark, vectors, cloud, anchors, block_rows):
    got = density.epsilon_join(vectors(spark, cloud), 0.7, anchors, block_rows).collect()
    d = gaps(cloud)
    want = {(i, j) for i in range(len(d)) for j in range(i + 1, len(d)) if d[i, j] <= 0.7}
    assert len(got) == len(want) and {(r["id_a"], r["id_b"]) for r in got} == want
    for r in got:
        assert r["distance"] == pytest.approx(d[r["id_a"], r["id_b"]])


@pytest.mark.parametrize("block_rows", [2048, 11])
def test_mean_distance_and_silhouette(spark, vectors, cloud, block_rows):
    df = vectors(spark, cloud)
    d = gaps(cloud)
    got = density.pairwise_mean_distance(df, block_rows).first()["mean_distance"]
    assert got == pytest.approx(d.mean())
    label = brute_dbscan(cloud, 0.5, 5)
    scores = []
    for i in range(len(d)):
        same = label == label[i]
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][label == c].mean() for c in set(label) if c != label[i])
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    rows = spark.createDataFrame(list(enumerate(label.tolist())), "doc_id long, cluster_id int")
    row = density.silhouette_exact(df.join(rows, "doc_id"), block_rows).first()
    assert row["clusters"] == len(set(label))
    assert row["silhouette"] == pytest.approx(np.mean(scores))


def test_one_cluster_has_no_silhouette(spark, vectors, cloud):
    from pyspark.sql import functions as F

    row = density.silhouette_exact(vectors(spark, cloud).withColumn("cluster_id", F.lit(0))).first()
    assert row["silhouette"] is None and row["clusters"] == 1


def test_sampled_mean_of_everything_is_the_mean(spark, vectors, cloud):
    got = density.sampled_mean_distance(vectors(spark, cloud), len(cloud), 2).first()["mean_distance"]
    assert got == pytest.approx(gaps(cloud).mean())


@pytest.mark.parametrize("anchors,block_rows", CUTS)
def test_forest_cut_at_every_radius(spark, vectors, cloud, anchors, block_rows):
    eps = [0.2, 0.35, 0.5, 0.7, 0.9, 1.4, 2.0, 100.0]
    df = vectors(spark, cloud)
    forest = density_forest.density_forest(df, eps[::-1], 6, anchors, block_rows)
    got = {(r["doc_id"], r["eps"]): r["cluster_id"] for r in density_forest.dbscan_at(df, forest).collect()}
    assert len(got) == len(cloud) * len(eps)
    for e in eps:
        assert [got[i, e] for i in range(len(cloud))] == brute_dbscan(cloud, e, 6).tolist(), e
    cores = {r["id"]: r["core"] for r in forest.points.collect()}
    assert all(level == sum((gaps(cloud)[i] <= e).sum() < 6 for e in eps) for i, level in cores.items())


def test_level_forest_has_fewer_edges_than_nodes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    reach, ids = kernels.levels(x, x, np.array([0.1, 0.3, 0.5, 4.0])), np.arange(60)
    node, _, level = kernels.level_forest(np.where(ids[:, None] < ids, reach, 4), ids, ids, 4)
    assert len(node) == 59 and set(level.tolist()) <= {0, 1, 2, 3}


@pytest.mark.parametrize("block_rows", [2048, 50])
def test_sweep(spark, vectors, cloud, block_rows):
    eps = [0.35, 0.5, 0.9, 100.0]
    df = vectors(spark, cloud)
    rows = density_forest.dbscan_sweep(df, eps, 5, block_rows).orderBy("eps").collect()
    want = []
    for e, row in zip(eps, rows):
        label = brute_dbscan(cloud, e, 5)
        named = spark.createDataFrame(list(enumerate(label.tolist())), "doc_id long, cluster_id int")
        want.append(density.silhouette_exact(df.join(named, "doc_id")).first()["silhouette"])
        assert row["n_clusters"] == len(set(label))
    assert want[-1] is None and rows[-1]["silhouette"] is None
    assert [r["silhouette"] for r in rows[:-1]] == pytest.approx(want[:-1])
    assert [r["best"] for r in rows] == [s == max(want[:-1]) for s in want]


def test_sweep_of_one_cluster_has_no_best_radius(spark, vectors, cloud):
    rows = density_forest.dbscan_sweep(vectors(spark, cloud), [100.0, 200.0], 5).collect()
    assert [r["best"] for r in rows] == [False, False]


def test_components(spark):
    rng = np.random.default_rng(2)
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(100, int(j)) for j in range(101, 160)]
    loose = [(int(a), int(b)) for a, b in rng.integers(200, 260, size=(40, 2))]
    edges = path + star + loose
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["root"] for r in components.connected_components(df).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert components.connected_components(df.where("src < 0")).count() == 0


def test_a_row_travels_no_more_often_in_a_larger_table(spark, vectors, cloud):
    df = vectors(spark, cloud)
    assert blocks.rows_of_a_block(df, 1000) == blocks.BLOCK_ROWS
    for rows in (10**5, 6 * 10**5):
        assert blocks.block_count(rows, blocks.rows_of_a_block(df, rows)) <= blocks.BLOCKS
    # blocks are bounded in bytes, of vectors and of results
    assert blocks.rows_of_a_block(df, 10**9) <= blocks.BLOCK_BYTES // 8
    assert blocks.rows_of_a_block(df, 10**9, 10**6) == blocks.BLOCK_ROWS


def test_links_in_pieces_and_sums_in_tiles(monkeypatch):
    monkeypatch.setattr(kernels, "TILE", 7)
    rng = np.random.default_rng(8)
    left, right = np.arange(40), np.arange(20, 70)
    i, j, level = rng.integers(0, 40, 30), rng.integers(0, 50, 30), rng.integers(0, 3, 30)
    links = kernels.LevelLinks(left, right, 3)
    for k in range(0, 30, 4):
        links.join(i[k : k + 4], j[k : k + 4], level[k : k + 4])
    node, root, at = links.forest()
    for most in range(3):
        parts = []
        for u, v in ((left[i[level <= most]], right[j[level <= most]]), (node[at <= most], root[at <= most])):
            name = np.arange(70)
            for _ in range(70):
                for a, b in zip(u, v):
                    name[a] = name[b] = min(name[a], name[b])
            parts.append(name)
        assert np.array_equal(*parts)
    a, b = rng.normal(size=(20, 3)), rng.normal(size=(31, 3))
    ga, gb = np.sort(rng.integers(0, 4, 20)), np.sort(rng.integers(0, 5, 31))
    ga[-1], gb[-1] = 3, 4
    far = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    to_b, to_a = kernels.cluster_sums(a, b, ga, gb)
    assert np.allclose(to_b, far @ (gb[:, None] == np.arange(5))) and np.allclose(to_a, far.T @ (ga[:, None] == np.arange(4)))
