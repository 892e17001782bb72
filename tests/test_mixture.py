"""Gaussian mixtures against a plain NumPy expectation-maximisation."""

import time

import numpy as np
import pytest

from docloom.functions import kernels
from docloom.operators import mixture


def log_density(x, mean, covariance):
    gap = x - mean
    _, logdet = np.linalg.slogdet(covariance)
    return -0.5 * (np.einsum("ij,jk,ik->i", gap, np.linalg.inv(covariance), gap) + logdet + x.shape[1] * np.log(2 * np.pi))


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(7)
    parts = []
    for c in range(4):
        shape = rng.normal(size=(5, 5)) * 0.4
        parts.append(rng.normal(size=(150, 5)) @ shape + rng.normal(0, 6, 5))
    x = np.vstack(parts)
    return x[rng.permutation(len(x))]


def test_responsibilities_and_one_step(spark, vectors, blobs):
    rng = np.random.default_rng(1)
    k, d = 3, blobs.shape[1]
    covariances = np.array([np.cov(rng.normal(size=(20, d)).T) + np.eye(d) for _ in range(k)])
    start = mixture.Mixture(np.array([0.2, 0.5, 0.3]), blobs[:k].copy(), covariances)
    logs = np.stack([np.log(w) + log_density(blobs, m, c) for w, m, c in zip(start.weights, start.means, start.covariances)], 1)
    likelihood = np.logaddexp.reduce(logs, axis=1)
    r = np.exp(logs - likelihood[:, None])
    found, total = mixture._sums(vectors(spark, blobs), {7: start})
    n, sums, products = found[7]
    assert total[7] == pytest.approx(likelihood.sum())
    assert n == pytest.approx(r.sum(0)) and sums == pytest.approx(r.T @ blobs)
    assert products == pytest.approx(np.einsum("ik,ia,ib->kab", r, blobs, blobs))
    pooled, strength = np.cov(blobs.T), 4.0
    after = mixture.maximise(n, sums, products, pooled, strength, start.means)
    for j in range(k):
        mean = r[:, j] @ blobs / r[:, j].sum()
        scatter = ((blobs - mean) * r[:, j : j + 1]).T @ (blobs - mean)
        assert after.means[j] == pytest.approx(mean)
        assert after.covariances[j] == pytest.approx((scatter + strength * pooled) / (r[:, j].sum() + strength))


@pytest.mark.parametrize("strength", [0.5, 5.0, 50.0])
def test_objective_never_falls(spark, vectors, blobs, strength):
    fits = mixture.fit_many(vectors(spark, blobs), [1, 3, 6], tol=1e-3, max_iter=25, strength=strength)
    assert list(fits) == [1, 3, 6]
    for m in fits.values():
        assert (np.diff(m.objective) > -1e-6).all() and np.isfinite(m.log_likelihood)
        assert m.weights.sum() == pytest.approx(1)


def test_finds_the_blobs(spark, vectors, blobs):
    found = mixture.gmm(vectors(spark, blobs), k=4, tol=0.01, seed=5)
    label = {r["doc_id"]: (r["cluster_id"], sum(r["probability"])) for r in found.assignments.collect()}
    assert len(label) == len(blobs) and all(p == pytest.approx(1) for _, p in label.values())
    assert found.measures["log_likelihood"] > log_density(blobs, blobs.mean(0), np.cov(blobs.T)).sum()


def test_singular_rows_and_more_components_than_rows(spark, vectors):
    x = np.vstack([np.zeros((40, 3)), np.ones((40, 3)), [[2.0, 0, 0]]])
    fits = mixture.fit_many(vectors(spark, x), [2, 200], max_iter=10)
    assert len(fits[200].weights) == 81 and np.isfinite(fits[200].log_likelihood) and np.isfinite(fits[2].log_likelihood)


def test_models_take_turns(spark, vectors, blobs, monkeypatch):
    df = vectors(spark, blobs)
    whole = mixture.fit_many(df, [2, 3, 4], max_iter=5, tol=0)
    monkeypatch.setattr(mixture, "SCAN_BYTES", 1)
    turns = mixture.fit_many(df, [2, 3, 4], max_iter=5, tol=0)
    for k in (2, 3, 4):
        assert turns[k].objective == pytest.approx(whole[k].objective)


def test_vanishing_responsibilities_cost_nothing_and_change_nothing():
    """Far components get no product of a row: 300 components over far rows take the time of their own rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 48)) + 40.0 * rng.integers(0, 300, 3000)[:, None]
    r = np.zeros((3000, 300))
    r[np.arange(3000), rng.integers(0, 300, 3000)] = 1.0
    r += 1e-25
    total = np.zeros((300, 48, 48))
    kernels.weighted_products(x, r, total)
    for j in (0, 7, 299):
        assert np.allclose(total[j], (x * r[:, j : j + 1]).T @ x, rtol=1e-12)


@pytest.mark.parametrize("n,k", [(1, 1), (300, 16), (700, 37)])
def test_responsibilities_in_blocks_equal_single_components(n, k):
    rng = np.random.default_rng(n)
    x, means = rng.normal(size=(n, 5)), rng.normal(size=(k, 5))
    white = np.triu(rng.normal(size=(k, 5, 5))) + 2 * np.eye(5)
    constants = rng.normal(size=k)
    likelihood, r = kernels.responsibilities(x, constants, means, white)
    logs = np.stack([constants[j] - 0.5 * (((x - means[j]) @ white[j]) ** 2).sum(axis=1) for j in range(k)], axis=1)
    want = np.log(np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)) + logs.max(axis=1)
    assert np.allclose(likelihood, want) and np.allclose(r, np.exp(logs - want[:, None]))


def test_sweep_scores_are_those_of_the_fits_without_scans(spark, vectors, blobs, monkeypatch):
    """Few rows: every k is fitted in a task of its own; beyond the bound by scans, with the same scores."""
    df, scans, plain = vectors(spark, blobs), [], mixture._sums
    fits = mixture.fit_many(df, [1, 4, 7, 900], tol=0.01, max_iter=20)
    monkeypatch.setattr(mixture, "_sums", lambda *a: scans.append(1) or plain(*a))
    found = mixture.gmm_sweep(df, [1, 4, 7, 900], tol=0.01, max_iter=20).collect()
    assert len(scans) == 1  # the pooled covariance
    assert [r["k"] for r in found] == [1, 4, 7, 900]
    for r in found:
        assert r["log_likelihood"] == pytest.approx(fits[r["k"]].log_likelihood, rel=1e-9)
        assert r["iterations"] == len(fits[r["k"]].objective) - 1
    monkeypatch.setattr(mixture, "LOCAL_BYTES", 1)
    again = mixture.gmm_sweep(df, [1, 4, 7], tol=0.01, max_iter=20).collect()
    assert len(scans) > 10 and [r["log_likelihood"] for r in again] == pytest.approx([r["log_likelihood"] for r in found[:3]])


@pytest.mark.parametrize("far,spread", [(0.0, 1.0), (1e3, 1.0), (1e5, 1.0), (1e3, 1e-4)])
def test_products_of_pairs_lose_no_digits_that_count(far, spread):
    rng = np.random.default_rng(2)
    means = far + rng.normal(size=(20, 6)) * (1.0 if spread == 1.0 else 50.0)
    x = means[rng.integers(0, 20, 400)] + spread * rng.normal(size=(400, 6))
    covariances = spread**2 * np.array([np.cov(rng.normal(size=(30, 6)).T) + np.eye(6) for _ in range(20)])
    one = mixture.Mixture(np.full(20, 0.05), means, covariances)
    likelihood, r = kernels.responsibilities(x, *one.factors())
    logs = np.stack([np.log(0.05) + log_density(x, m, c) for m, c in zip(means, covariances)], 1)
    want = np.logaddexp.reduce(logs, axis=1)
    assert np.allclose(likelihood, want, atol=1e-6) and np.allclose(r, np.exp(logs - want[:, None]), atol=1e-6)


def test_dense_weights_share_one_product():
    """Components that overlap: the products of all components take less than half the time of one product for each."""
    rng = np.random.default_rng(4)
    x, r = rng.normal(size=(2048, 64)), rng.dirichlet(np.full(150, 0.2), 2048)
    r = np.maximum(r, 1e-15)
    best, want = [np.inf, np.inf], np.zeros((150, 64, 64))
    for _ in range(3):
        total, started = np.zeros((150, 64, 64)), time.process_time()
        kernels.weighted_products(x, r, total)
        best[0], started = min(best[0], time.process_time() - started), time.process_time()
        for j in range(150):
            want[j] = (x * r[:, j, None]).T @ x
        best[1] = min(best[1], time.process_time() - started)
    assert np.allclose(total, want) and best[0] < best[1] / 2


def test_one_pass_with_shared_products_equals_two(spark, vectors, blobs):
    """Stored matrices give their sums to the driver; components beyond the reach of products of pairs are whitened."""
    rng = np.random.default_rng(8)
    for far, narrow in ((0.0, 1.0), (1e4, 1.0), (0.0, 1e-4)):
        x = blobs + far
        covariances = narrow**2 * np.array([np.cov(rng.normal(size=(20, 5)).T) + np.eye(5) for _ in range(6)])
        one = mixture.Mixture(np.full(6, 1 / 6), x[:6].copy(), covariances)
        likelihood, r = kernels.responsibilities(x, *one.factors())
        middle = one.means.mean(axis=0)
        total, sums = kernels.expectations([x[:100], x[100:]], *one.factors(), middle)
        products = np.zeros((6, 5, 5))
        kernels.weighted_products(x - middle, r, products)
        assert total == pytest.approx(likelihood.sum()) and np.allclose(sums[:, 0], r.sum(axis=0))
        assert np.allclose(kernels.unfold(sums[:, 1:-5], 5), products, rtol=1e-6, atol=1e-6)
        assert np.allclose(sums[:, -5:], r.T @ (x - middle), atol=1e-6)
        df = vectors(spark, x)
        scanned, direct = mixture._sums(df, {3: one}), mixture._sums(df, {3: one}, mixture.matrices(df))
        assert scanned[1][3] == pytest.approx(direct[1][3]) == pytest.approx(total)
        assert all(np.allclose(a, b) for a, b in zip(scanned[0][3], direct[0][3]))
