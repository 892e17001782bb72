"""Clustering, maps, topics and search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import assign, cluster, report, search, som, topics
from docloom.operators.features import build_vocab, term_stats
from docloom.plans import pipeline


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(3)
    return np.vstack([rng.normal(c, 0.3, size=(60, 4)) for c in (0.0, 4.0, -4.0)])


@pytest.fixture(scope="module")
def points(spark, vectors, blobs):
    return vectors(spark, blobs)


def check_labels(rows, n, k):
    assert sorted(r["doc_id"] for r in rows) == list(range(n))
    assert all(0 <= r["cluster_id"] < k for r in rows)


def test_kmeans_finds_the_blobs_and_repeats(points, blobs):
    first = cluster.kmeans(points, 3, max_iter=50, partitions=3)
    rows = first.assignments.collect()
    check_labels(rows, len(blobs), 3)
    groups = {}
    for r in rows:
        groups.setdefault(r["doc_id"] // 60, set()).add(r["cluster_id"])
    assert [len(g) for g in groups.values()] == [1, 1, 1]
    again = cluster.kmeans(points.repartition(5), 3, max_iter=50, partitions=3)
    assert again.measures["wss"] == first.measures["wss"] and len(first.centres) == 3


def test_other_models(points, blobs):
    check_labels(cluster.bisecting_kmeans(points, 3).assignments.collect(), len(blobs), 3)
    mixture = cluster.gmm(points, 3, max_iter=20)
    rows = mixture.assignments.collect()
    check_labels(rows, len(blobs), 3)
    assert all(sum(r["probability"]) == pytest.approx(1.0) for r in rows)


def test_sweeps(points):
    rows = cluster.kmeans_sweep(points, [2, 3, 4], max_iter=20).orderBy("k").collect()
    assert rows[0]["wss"] > rows[1]["wss"] > rows[2]["wss"]
    assert all(-1 <= r["silhouette"] <= 1 and r["seconds"] > 0 for r in rows)
    sweep = cluster.kmeans_sweep(points, [2, 3], max_iter=20)
    assert cluster.best_k(sweep).first()["k"] == 3
    assert cluster.gmm_sweep(points, [2], max_iter=5).first()["log_likelihood"] < 1e9


def test_best_k_prefers_the_smaller_on_a_tie(spark):
    df = spark.createDataFrame([(5, 0.5), (3, 0.5), (9, 0.1)], "k int, silhouette double")
    assert cluster.best_k(df).first()["k"] == 3


def test_lda(spark):
    rows = [(i, (["cat", "dog", "pet"] if i % 2 else ["atom", "ion", "mass"]) * 3) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    model = cluster.lda(df, 2, max_iter=20)
    got = model.assignments.collect()
    check_labels(got, 30, 2)
    assert all(sum(r["topics"]) == pytest.approx(1.0) for r in got)
    best = [r["best"] for r in cluster.lda_sweep(df, [2, 3], max_iter=5).collect()]
    assert sorted(best) == [False, True]


@pytest.mark.parametrize("model_bytes,block_rows", [(10**9, 2048), (0, 16)])
def test_assign_nearest_both_routes(spark, points, blobs, model_bytes, block_rows):
    """Broadcast centres and centre blocks give the same answer; ties go to the lower id."""
    centres = np.vstack([blobs[::20], blobs[:1]])
    df = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cluster_id int, vec array<double>")
    got = {r["doc_id"]: r for r in assign.assign_nearest(points, df, model_bytes, block_rows).collect()}
    squared = ((blobs[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert len(got) == len(blobs)
    for i, row in enumerate(squared):
        assert got[i]["cluster_id"] == row.argmin()
        assert got[i]["distance2"] == pytest.approx(row.min())


def test_lloyd_steps_never_raise_the_cost(spark, points, blobs):
    centres = spark.createDataFrame([(i, [float(v) for v in blobs[i * 7]]) for i in range(4)], "cluster_id int, vec array<double>")
    costs = []
    for _ in range(3):
        costs.append(assign.wss(assign.assign_nearest(points, centres)).first()["wss"])
        centres = assign.lloyd_step(points, centres)
    assert costs == sorted(costs, reverse=True)


def test_som(points, blobs):
    fitted = som.som(points, 3, 3, iterations=8, radius_start=3.0, radius_end=0.5)
    check_labels(fitted.assignments.collect(), len(blobs), 9)
    # the first cost belongs to the start vectors, which no smoothing has touched yet
    assert len(fitted.history) == 8 and fitted.history[1:] == sorted(fitted.history[1:], reverse=True)


def test_som_step(points, blobs):
    book = blobs[:4]
    moved, cost = som.som_step(points, book, 2, 2, 1.0)
    squared = ((blobs[:, None, :] - book[None]) ** 2).sum(axis=2)
    unit = squared.argmin(axis=1)
    weights = som.grid_kernel(2, 2, 1.0)[:, unit]
    assert moved == pytest.approx(weights @ blobs / weights.sum(axis=1)[:, None])
    assert cost == pytest.approx(squared.min(axis=1).mean())


def test_reports(spark):
    df = spark.createDataFrame([(1, -1), (2, 0), (3, 0)], "doc_id long, cluster_id int")
    assert [tuple(r) for r in report.cluster_sizes(df).collect()] == [(-1, 1), (0, 2)]
    assert [r[0] for r in report.cluster_ids(df).collect()] == [-1, 0]
    assert report.n_clusters(df).first()[0] == 2


@pytest.fixture(scope="module")
def topic_model(spark):
    tokens = spark.createDataFrame(
        [(1, ["cat", "cat", "dog"]), (2, ["cat", "sun"]), (3, ["sun", "moon", "sun"])], "doc_id long, tokens array<string>"
    )
    clusters = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, cluster_id int")
    return tokens, clusters, pipeline.describe_clusters(tokens, clusters, 2, 100, 1)


def test_topics_are_smoothed_tfidf_sums(topic_model):
    _, _, model = topic_model
    idf = {t: math.log(4 / (df + 1)) for t, df in {"cat": 2, "dog": 1, "sun": 2, "moon": 1}.items()}
    sums = {0: {"cat": 3 * idf["cat"], "dog": idf["dog"], "sun": idf["sun"]}, 1: {"sun": 2 * idf["sun"], "moon": idf["moon"]}}
    for r in model.topics.collect():
        want = (1 + sums[r["cluster_id"]][r["term"]]) / (4 + sum(sums[r["cluster_id"]].values()))
        assert r["weight"] == pytest.approx(want)
    assert {r["cluster_id"]: r["tags"] for r in model.taggings.collect()} == {0: ["cat", "dog"], 1: ["moon", "sun"]}


def test_relevant_documents(topic_model):
    tokens, clusters, model = topic_model
    rows = topics.attach_clusters(tokens, clusters)
    weights = topics.document_weights(rows, model.topics, model.vocab, model.documents, 100, 2)
    assert [r["doc_id"] for r in topics.relevant_documents(weights, 1, cluster_id=0).collect()] == [1]
    assert sorted((r["cluster_id"], r["doc_id"]) for r in topics.relevant_documents(weights, 1).collect()) == [(0, 1), (1, 3)]


def test_each_document_appears_once(topic_model):
    tokens, clusters, model = topic_model
    rows = topics.clustered_documents(tokens, clusters, model.taggings).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 3] and all(len(r["tags"]) == 2 for r in rows)


def test_parse_and_dedupe_taggings(spark):
    lines = ["3 cat, dog", "4 sun   ", "x moon, cat", "7", "", "-1 noise, dog", "5, bare", "12abc no", "99999999999 big"]
    df = spark.createDataFrame(list(enumerate(lines)), "line int, value string")
    parsed = search.parse_taggings(df)
    assert sorted((r["line"], r["position"], r["tag"], r["cluster_id"]) for r in parsed.collect()) == [
        (0, 0, "cat", 3), (0, 1, "dog", 3), (1, 0, "sun", 4), (5, 0, "noise", -1), (5, 1, "dog", -1), (6, 1, "bare", 5),
    ]
    assert {r["tag"]: r["cluster_id"] for r in search.dedupe_tags(parsed).collect()}["dog"] == -1


TAGS = [("a", 1, [1.0, 0.0]), ("b", 1, [2.0, 2.0]), ("c", 2, [3.0, 3.0]), ("d", 3, [0.0, 1.0]), ("e", 4, [-1.0, 0.0])]


def test_search_keeps_ties_with_the_last_and_floors_at_zero(spark):
    tags = spark.createDataFrame(TAGS, "tag string, cluster_id int, vec array<double>")
    query = F.lit([1.0, 0.0])
    two = {r["cluster_id"]: r["score"] for r in search.search(query, tags, 2).collect()}
    assert two == {1: 1.0, 2: pytest.approx(math.sqrt(0.5))}
    every = {r["cluster_id"]: r["score"] for r in search.search(query, tags, 9).collect()}
    assert every[4] == 0.0 and len(every) == 4


@pytest.mark.parametrize("model_bytes,block_rows", [(10**9, 2048), (0, 3)])
def test_search_batch_equals_single_searches(spark, model_bytes, block_rows):
    rng = np.random.default_rng(4)
    rows = TAGS + [(f"t{i}", int(i % 5), [float(v) for v in rng.normal(size=2)]) for i in range(20)]
    tags = spark.createDataFrame(rows, "tag string, cluster_id int, vec array<double>")
    asked = [[1.0, 0.0], [0.5, 0.5], [-1.0, 2.0], [0.0, 0.0]]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, vec array<double>")
    got = {}
    for r in search.search_batch(queries, tags, 3, model_bytes, block_rows).collect():
        got.setdefault(r["query_id"], {})[r["cluster_id"]] = r["score"]
    for i, vec in enumerate(asked):
        want = {r["cluster_id"]: r["score"] for r in search.search(F.lit(vec), tags, 3).collect()}
        assert got[i] == pytest.approx(want)


def test_text_search_prefers_the_cluster_with_the_word(spark):
    tags = spark.createDataFrame([("virus", 1, 0, 0), ("galaxy", 2, 1, 0)], "tag string, cluster_id int, line int, position int")
    best = pipeline.search_text("virus", tags).orderBy(F.desc("score")).first()
    assert (best["cluster_id"], best["score"]) == (1, pytest.approx(1.0))


def test_topic_plan_has_no_cartesian_product(topic_model):
    tokens, clusters, model = topic_model
    vocab = build_vocab(term_stats(tokens), 10, 1)
    plan = topics.cluster_topics(topics.attach_clusters(tokens, clusters), vocab, 3, 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text
