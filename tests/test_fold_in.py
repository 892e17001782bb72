"""Fold-in inference for given topics against plain loops."""

import numpy as np
import pyarrow as pa
import pytest

from docloom.functions import kernels
from docloom.operators import fold_in


def brute(words, terms, phi, steps):
    theta = np.full(len(phi), 1 / len(phi))
    known = [terms.index(w) for w in words if w in terms]
    for _ in range(steps if known else 0):
        total = np.zeros(len(phi))
        for w in known:
            share = theta * phi[:, w]
            total += share / share.sum()
        theta = total / total.sum()
    return theta


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [f"t{rng.integers(0, 12)}" for _ in range(rng.integers(0, 30))], i % 3) for i in range(60)] + [(99, None, 1), (100, ["odd"], 2)]
    return rows, spark.createDataFrame(rows, "doc_id long, tokens array<string>, cluster_id int").repartition(3)


@pytest.mark.parametrize("steps", [0, 1, 5])
def test_distributions(corpus, steps):
    rows, df = corpus
    rng = np.random.default_rng(1)
    terms, phi = [f"t{k}" for k in range(10)], rng.dirichlet(np.ones(10), 4)
    got = {r["doc_id"]: r["topics"] for r in fold_in.distributions(df, terms, phi, steps).collect()}
    assert len(got) == len(rows)
    for i, words, _ in rows:
        assert got[i] == pytest.approx(brute(words or [], terms, phi, steps))


def test_smoothed_topics_and_ranking(corpus):
    rows, df = corpus
    terms = [f"t{k}" for k in range(10)]
    ids, phi = fold_in.smoothed_topics(df, terms)
    assert ids == [0, 1, 2]
    for c in ids:
        n = np.array([1 + sum((w or []).count(t) for _, w, k in rows if k == c) for t in terms])
        assert phi[c] == pytest.approx(n / n.sum())
    found = {r["doc_id"]: r["topics"] for r in fold_in.distributions(df, terms, phi).collect()}
    top = fold_in.documents_of_topics(fold_in.distributions(df, terms, phi), 4).collect()
    for c in ids:
        want = sorted(found, key=lambda i: (-round(found[i][c], 9), i))[:4]
        assert [r["doc_id"] for r in sorted(top, key=lambda r: r["rank"]) if r["topic"] == c] == want


def test_topics_are_bounded(corpus):
    with pytest.raises(ValueError):
        fold_in.distributions(corpus[1], ["a"], np.broadcast_to(0.0, (10**5, 10**5)))


@pytest.mark.parametrize("most", [1, 5, 10**6])
def test_term_runs_are_whole_rows_by_term(most):
    rng = np.random.default_rng(2)
    rows = [None, [], ["odd"]] + [[f"t{rng.integers(0, 9)}" for _ in range(rng.integers(0, 12))] for _ in range(30)] + [["t1", None, "t1"]]
    place = {f"t{i}": i for i in range(8)}
    got, pieces = {}, list(kernels.term_runs(pa.array(rows, pa.list_(pa.string())), place, most))
    for owners, at, counts in pieces:
        assert len(at) <= most or len(set(owners.tolist())) == 1
        for row, term, n in zip(owners.tolist(), at.tolist(), counts.tolist()):
            assert (row, term) not in got
            got[row, term] = n
    assert sum(len({*o.tolist()}) for o, _, _ in pieces) == len({row for row, _ in got})
    want = {(i, place[t]): row.count(t) for i, row in enumerate(rows) if row for t in row if t in place}
    assert got == want
