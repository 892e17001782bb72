import math

import numpy as np
import pytest

from docloom.llm import embedding_dedup as E


def brute(rows, least):
    good = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float) / max(abs(y) for y in v)
            good[i] = x / np.linalg.norm(x)
    links, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= least:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (links[i], find(i), find(i) == i) for i, _ in rows}


def sample(seed=2):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=16).tolist() for _ in range(150)]
    for centre, size in ((3, 60), (7, 25), (11, 2), (12, 3)):
        rows += [(np.array(rows[centre]) + rng.normal(size=16) * 0.25).tolist() for _ in range(size)]
    rows += [rows[3]] * 20 + [(np.array(rows[3]) * 2).tolist()]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.1], [1e-200] * 16, [1e200] * 16]
    return [(i * 7 % 1009, v) for i, v in enumerate(rows + odd)]


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rows = sample()
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, digest string").repartition(6)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.link_vectors(frame, 0.9).collect()}
    assert got == brute(rows, 0.9)


def test_window_over_batches(spark):
    """Small Arrow batches: windows reach into the next batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = sample(5)
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.link_vectors(frame, 0.9).collect()}
        assert got == brute(rows, 0.9)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def dense_table(n, inner, dim=64, planted=150, seed=8):
    """A third of the rows in one region with this cosine among each other, pairs at 0.92 in it, the rest spread evenly."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    centre, hot = unit(rng.normal(size=(1, dim))), n // 3
    aside = unit(rng.normal(size=(hot, dim)) - (rng.normal(size=(hot, dim)) @ centre.T) * centre)
    x = np.vstack([unit(centre * math.sqrt(inner) + aside * math.sqrt(1 - inner)), unit(rng.normal(size=(n - hot, dim)))])
    near = unit(rng.normal(size=(planted, dim)))
    near = unit(near - (near * x[:planted]).sum(1, keepdims=True) * x[:planted])
    return np.vstack([x, x[:planted] * 0.92 + near * math.sqrt(1 - 0.92**2)])


@pytest.mark.parametrize("inner", [0.7, 0.8, 0.85])
def test_recall_in_a_dense_region(spark, inner):
    x = dense_table(9000, inner)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.link_vectors(frame, 0.9).collect()}
    pairs = [(i + k, j) for k in range(0, len(x), 1000) for i, j in zip(*np.nonzero(x[k : k + 1000] @ x.T >= 0.9)) if i + k < j]
    assert len(pairs) >= 150
    joined = [got[i][1] == got[j][1] for i, j in pairs]
    assert np.mean(joined) >= 0.99
    counts = np.bincount(np.array(pairs).ravel(), minlength=len(x))
    assert np.mean([got[i][0] == counts[i] for i in range(len(x))]) >= 0.995


def test_rows_of_the_last_round_are_compared_completely(spark, monkeypatch):
    monkeypatch.setattr(E, "WIDEST", 1)
    monkeypatch.setattr(E, "BLOCK", 16)
    rows = sample(6)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.link_vectors(frame, 0.9).collect()}
    assert got == brute(rows, 0.9)


def test_chance_to_miss_is_that_of_random_partners():
    """Keys of random partners at the threshold fall out of the window about as often as said."""
    rng, dim, n, window = np.random.default_rng(3), 32, 4000, 24
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    planes = rng.normal(size=(dim, E.KEY_BITS))
    bits = 1 << np.arange(E.KEY_BITS - 1, -1, -1, dtype=np.int64)
    keys = np.sort((x @ planes >= 0) @ bits)
    order = np.argsort((x @ planes >= 0) @ bits, kind="stable")
    said = np.exp(E.log_miss(keys, window, 0.9, False, False))
    other = rng.normal(size=(n, dim))
    other -= (other * x[order]).sum(1, keepdims=True) * x[order]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    partner = (x[order] * 0.9 + other * math.sqrt(1 - 0.81)) @ planes >= 0
    gap = np.abs(np.searchsorted(keys, partner @ bits) - np.arange(n))
    assert abs((gap > window).mean() - said.mean()) < 0.05 and (gap > window).mean() < said.mean() + 0.02


def test_forest_connects_what_the_pairs_do():
    rng = np.random.default_rng(2)
    for _ in range(50):
        i, j = rng.integers(0, 40, size=(2, 30))
        row, root = E.forest(40, i, j)
        assert len(set(row.tolist())) == len(row) and (root < row).all()
        label = np.arange(40)
        label[row] = root
        assert (label[i] == label[j]).all() and (label[label] == label).all()


def test_passes_grow_with_the_input():
    assert E.passes_for(10, 0.9) < E.passes_for(10**5, 0.9) < E.passes_for(10**9, 0.9) < 1000


def test_empty_table_and_odd_ids(spark):
    assert E.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.1]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (9, [0.0, 1.0]), (None, [0.0, -1.0])]
    got = E.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    seen = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in got)
    assert seen[1:] == [(-1, 3, 4), (-1, 3, 4), (4, 3, 4), (4, 3, 4), (9, 0, 9)] and seen[0][:2] == (-1, 0) or seen[0][2] is None
    assert sum(r["kept"] for r in got) == 3
