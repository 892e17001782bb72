"""Features against direct computation."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from docloom.operators import features

DOCS = [(1, ["b", "a", "b"]), (2, ["a"]), (3, ["c", "b", "", "c", "c"]), (4, [])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, tokens array<string>")


def test_term_counts(docs):
    got = {r["doc_id"]: {t["term"]: t["tf"] for t in r["t"]}
           for r in docs.select("doc_id", features.term_counts(F.col("tokens")).alias("t")).collect()}
    assert got == {i: dict(Counter(t)) for i, t in DOCS}


def test_stats_and_vocab(docs):
    stats = {r["term"]: (r["tf"], r["df"]) for r in features.term_stats(docs).collect()}
    assert stats == {"a": (2, 2), "b": (3, 2), "c": (3, 1), "": (1, 1)}
    vocab = features.build_vocab(features.term_stats(docs), 2, 1).orderBy("term_id").collect()
    assert [(r["term"], r["term_id"]) for r in vocab] == [("b", 0), ("c", 1)]
    assert features.build_vocab(features.term_stats(docs), 9, 2).count() == 2


def test_counting_terms_needs_no_shuffle(docs):
    plan = features.doc_terms(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_idf_matches_the_ml_transformer(docs):
    """Long form and ML vectors are two routes to the same weights."""
    rows = docs.where(F.size("tokens") > 0)
    vocab = features.build_vocab(features.term_stats(rows), 10, 1)
    long = {(r["doc_id"], r["term"]): r["weight"] for r in features.idf_weight(rows, vocab, rows.count(), 10).collect()}
    ml, words = features.tfidf_vectors(rows, 10, 1.0)
    for r in ml.select("doc_id", vector_to_array("features").alias("v")).collect():
        for word, value in zip(words, r["v"]):
            assert long.get((r["doc_id"], word), 0.0) == pytest.approx(value)


def test_tfidf_l2_routes_agree(spark):
    df = spark.createDataFrame([(1, "Two two words"), (2, "words, more words a"), (3, "été")], "doc_id long, text string")
    long = {}
    for r in features.tfidf_l2(df, 3, 100).collect():
        long.setdefault(r["doc_id"], []).append(r["weight"])
    for r in features.tfidf_l2_vectors(df, 100).select("doc_id", vector_to_array("features").alias("v")).collect():
        values = sorted(x for x in r["v"] if x)
        assert values == pytest.approx(sorted(long[r["doc_id"]]))
        assert sum(x * x for x in values) == pytest.approx(1.0)


def test_hashing(docs):
    rows = features.hashing_tf(docs, 64).select("doc_id", vector_to_array("features").alias("v")).collect()
    assert {r["doc_id"]: sum(r["v"]) for r in rows} == {i: len(t) for i, t in DOCS}
    assert features.hashed_tfidf(docs, 64).count() == 4


@pytest.fixture(scope="module")
def points(spark, vectors):
    x = np.random.default_rng(1).normal(size=(200, 6)) * np.array([5, 3, 1, 1, 0.5, 0.1])
    return x, vectors(spark, x)


def test_covariance(points):
    x, df = points
    want = np.cov(x.T)
    for r in features.covariance(df).collect():
        assert r["cov"] == pytest.approx(want[r["i"], r["j"]])


def test_pca(points):
    x, df = points
    rows = df.select("doc_id", array_to_vector("vec").alias("features"))
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    got = {r["doc_id"]: r["vec"] for r in features.pca_project(rows, 3).collect()}
    for i, row in enumerate(centred @ vt[:3].T):
        assert np.abs(got[i]) == pytest.approx(np.abs(row), abs=1e-6)
    shares = s**2 / (s**2).sum()
    kept, ratios = features.pca_variance(rows, 0.9)
    assert ratios == pytest.approx(shares)
    assert ratios == sorted(ratios, reverse=True)
    assert len(kept.first()["vec"]) == int(np.argmax(np.cumsum(shares) > 0.9)) + 1


def test_embedding_of_a_text_is_the_sum_of_its_trigrams(one):
    a, b = one(lambda c: features.embed_text(c, 16), ["cat", ""])
    assert sum(a) == 3 and sum(b) == 0 and len(a) == 16
