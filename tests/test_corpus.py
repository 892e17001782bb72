"""Corpus operators on hand-made rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from docloom.operators import corpus, language
from docloom.plans import pipeline


def test_join_metadata_takes_the_first_row_and_drops_the_rest(spark):
    papers = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", "c")], "paper_id string, abstract string")
    meta = spark.createDataFrame(
        [("p1", "late", 5), ("p1", None, 2), ("p2", "x", 1), (None, "n", 0)], "sha string, title string, meta_order int"
    )
    got = {r["paper_id"]: r["title"] for r in corpus.join_metadata(papers, meta).collect()}
    assert got == {"p1": None, "p2": "x"}


def test_dedupe_keeps_smallest_id_and_treats_nulls_as_equal(spark):
    rows = [(3, "a", "b"), (1, "a", "b"), (2, "a", None), (4, "a", None), (5, "ab", "")]
    df = spark.createDataFrame(rows, "id long, abstract string, body_text string")
    got = sorted(r["id"] for r in corpus.dedupe(df, ["abstract", "body_text"], "id").collect())
    assert got == [1, 2, 5]


def test_describe_text(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (4, "x"), (5, None)], "id long, t string")
    row = corpus.describe_text(df, ["t"], "id").first()
    assert (row["count"], row["unique"], row["top"], row["freq"]) == (4, 2, "x", 2)


@pytest.mark.parametrize("partitions", ["1", "3", "7"])
def test_row_ids_are_dense_whatever_the_layout(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id")).repartition(5)
        got = corpus.with_row_id(df, ["k"]).orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["row_id"] for r in got] == list(range(1, 1001))
    assert [r["k"] for r in got] == list(range(1000))


def test_zip_by_position_with_different_partitions_and_lengths(spark):
    a = spark.range(50).withColumnRenamed("id", "a").repartition(7)
    b = spark.range(100, 140).withColumnRenamed("id", "b").repartition(2)
    got = corpus.zip_by_position(a, b, ["a"], ["b"]).orderBy("position").collect()
    assert [(r["position"], r["a"], r["b"]) for r in got] == [(i, i, 100 + i) for i in range(40)]


def test_clean_tokens_drops_documents_without_words(spark):
    df = spark.createDataFrame([(1, ["12", ""]), (2, ["b", "", "7", "a"]), (3, [])], "doc_id long, tokens array<string>")
    assert [(r["doc_id"], r["tokens"]) for r in corpus.clean_tokens(df).collect()] == [(2, ["b", "a"])]


def test_lemmatize(spark):
    df = spark.createDataFrame([(1, ["Cells", "it", "went", "Cells"])], "doc_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("Cells", " Cell "), ("it", None)], "token string, lemma string")
    assert corpus.lemmatize(df, lemmas).first()["text"] == "cell it went cell"


def draw(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def test_samples_depend_on_ids_and_seed_alone(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    got = {r["doc_id"] for r in corpus.sample_docs(df.repartition(9), 0.2, 3).collect()}
    assert got == {i for i in range(2000) if draw(i, 3) < int(0.2 * 2**32)}
    picked = corpus.sample_n(df.repartition(5), 10, 3, 3).collect()
    for rep in range(3):
        want = sorted(range(2000), key=lambda i: (draw(i, rep, 3), i))[:10]
        assert sorted(r["doc_id"] for r in picked if r["rep"] == rep) == sorted(want)


def test_sample_n_is_limited_before_the_shuffle(spark):
    plan = corpus.sample_n(spark.range(100).withColumnRenamed("id", "doc_id"), 10, 3, 3)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_rank_limits_beyond_the_map_limit(spark, monkeypatch):
    """More rows per group than Spark limits in the map tasks: no window over a whole group, the same rows."""
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    large = corpus.sample_n(ids, 1001, 2, 3)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and large.groupBy("rep").count().where("count = 1001").count() == 2
    small = corpus.sample_n(ids, 200, 2, 3)
    monkeypatch.setattr(corpus, "MAP_LIMIT", 10)
    assert sorted(map(tuple, corpus.sample_n(ids, 200, 2, 3).collect())) == sorted(map(tuple, small.collect()))


def test_dedupe_moves_no_payload(spark):
    rows = [(i, "text %d" % (i % 40), i) for i in range(100)] + [(200, None, 1), (201, None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    kept = corpus.dedupe(df, ["text"], "doc_id")
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 200]
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_metadata_order_may_be_a_column(spark):
    papers = spark.createDataFrame([("a",)], "paper_id string")
    metadata = spark.createDataFrame([("a", "x", 2), ("a", "y", 1)], "sha string, title string, meta_order int")
    assert corpus.join_metadata(papers, metadata, order=F.col("meta_order")).first()["title"] == "y"


def test_language_fallback_chain(spark):
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 3, "text string, lang string"
    )
    model = language.fit_language_model(train)
    assert model.languages == ["de", "en"]
    rows = [
        (1, "the dog and the cat", ""),
        (2, "und der hund", ""),
        (3, "9 " * 60 + "the cat", ""),   # nothing known in the first 50 words
        (4, "", "the dog"),               # only the summary helps
        (5, "99 88", "77"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, body_text string, abstract_summary string")
    got = {r["doc_id"]: r["language"] for r in language.detect_language(df, model).collect()}
    assert got == {1: "en", 2: "de", 3: "en", 4: "en", 5: "unknown"}


def test_paper_table(spark):
    papers = spark.createDataFrame(
        [("p1", "", "one two two"), ("p2", "", "one two two"), ("p3", "x", "y"), ("p4", "m", "n")],
        "paper_id string, abstract string, body_text string",
    )
    meta = spark.createDataFrame(
        [(f"p{i}", "T", "A;B", "J", "d" if i != 4 else None, i) for i in (1, 2, 3, 4)],
        "sha string, title string, authors string, journal string, doi string, meta_order int",
    )
    got = {r["paper_id"]: r for r in pipeline.paper_table(papers, meta).collect()}
    assert sorted(got) == ["p1", "p3"]
    assert got["p1"]["abstract_summary"] == "Not provided." and got["p1"]["authors"] == "A. B"
    assert (got["p1"]["body_word_count"], got["p1"]["body_unique_words"], got["p1"]["abstract_word_count"]) == (3, 2, 0)


def test_lemmas_are_looked_up_where_the_tokens_are(spark, monkeypatch):
    """Both routes give the same texts, of repeated ids too; only the shuffled one makes a row per token."""
    rows = [(1, ["Went", "x", None]), (1, ["cells"]), (2, []), (3, None), (4, ["it", "cells"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("cells", " Cell"), ("it", None), ("x", "the")], "token string, lemma string")
    for words in (None, ["the"]):
        near = corpus.lemmatize(df, lemmas, words=words)
        assert "Generate" not in near._jdf.queryExecution().executedPlan().toString()
        with monkeypatch.context() as m:
            m.setattr(corpus, "BROADCAST_BYTES", 0)
            far = sorted(map(tuple, corpus.lemmatize(df, lemmas, words=words).collect()))
        assert sorted(map(tuple, near.collect())) == far
    assert [r[0] for r in far] == [1, 4]
