import math
import random
from collections import Counter

import numpy as np

from docloom.operators import features, meaning
from docloom.plans.pipeline import search_meaning

TOPICS = (
    "virus fever cough lung patient ward nurse vaccine dose symptom throat blood".split(),
    "tariff market price trade export import tax duty goods port broker profit".split(),
)


def token_lists():
    """Texts on one of two topics; two words of a topic never share a text, only the company of the others."""
    rng = random.Random(3)
    out = []
    for i in range(400):
        words = TOPICS[i % 2]
        own = [words[i // 2 % 2], *words[2:]]
        out.append([rng.choice([*own, "the", "of"]) for _ in range(rng.randint(0, 30))])
    return out


def frame(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "doc_id long, tokens array<string>").repartition(3)


def vocab_of(df):
    return features.build_vocab(features.term_stats(df), 50, 1)


def test_pairs_and_ppmi_against_brute_force(spark):
    lists = [*token_lists(), None, [], ["lung"], ["lung", None, "rare1", "lung", "lung"]]
    df = frame(spark, lists)
    vocab = vocab_of(df).where("term <> 'rare1'")
    ids = {r["term"]: r["term_id"] for r in vocab.collect()}
    want = Counter()
    for words in lists:
        for i, x in enumerate(words or []):
            for j, y in enumerate(words):
                if i != j and abs(i - j) <= 3 and x in ids and y in ids:
                    want[ids[x], ids[y]] += 1
    pairs = meaning.cooccurrences(df, vocab, 50, window=3)
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == want
    sums = Counter()
    for (a, _), n in want.items():
        sums[a] += n
    total = sum(want.values())
    scores = {k: math.log(n * total / sums[k[0]] / sums[k[1]] / 1.1) for k, n in want.items()}
    got = {(r["a"], r["b"]): r["ppmi"] for r in meaning.ppmi(pairs, 50, 1.1).collect()}
    assert got.keys() == {k for k, x in scores.items() if x > 0}
    assert all(abs(got[k] - scores[k]) < 1e-9 for k in got)


def test_related_terms_outrank_unrelated_ones(spark):
    df = frame(spark, token_lists())
    terms = meaning.fit(df, vocab_of(df), 50, k=2)
    vecs = {r["term"]: np.array(r["vec"]) for r in terms.collect()}

    def near(a, b):
        return vecs[a] @ vecs[b] / np.linalg.norm(vecs[a]) / np.linalg.norm(vecs[b])

    for own, other in (TOPICS, TOPICS[::-1]):
        assert near(own[0], own[1]) > 0.5 > max(near(own[0], w) for w in other)  # the two have never met
    tags = spark.createDataFrame([("virus", 1, 1, 0), ("trade", 2, 2, 0), ("unheard", 3, 3, 0)], "tag string, cluster_id int, line int, position int")
    found = {r["cluster_id"]: r["score"] for r in search_meaning("Fever!", tags, terms, 50).collect()}
    assert found[1] > 0.5 and found[1] > found[2] and 3 not in found
    fallback = {r["cluster_id"]: r["score"] for r in search_meaning("unheard", tags, terms, 50).collect()}
    assert max(fallback, key=fallback.get) == 3


def test_texts_are_weighted_means(spark):
    terms = spark.createDataFrame([("a", [1.0, 0.0], 1.0), ("b", [0.0, 1.0], 0.5)], "term string, vec array<double>, weight double")
    texts = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["zz"]), (3, []), (4, None)], "doc_id long, tokens array<string>")
    assert [tuple(r) for r in meaning.embed_tokens(texts, terms, 10).collect()] == [(1, [0.5, 0.5])]


def test_pairs_over_small_pieces_and_many_hand_overs(spark, monkeypatch):
    """Counts do not depend on where a task cuts its tokens or hands its pairs on."""
    monkeypatch.setattr(meaning, "PIECE", 7)
    monkeypatch.setattr(meaning, "KEYS", 20)
    monkeypatch.setattr(meaning, "ROWS_OUT", 6)
    lists = token_lists()[:120]
    df = frame(spark, lists)
    vocab = vocab_of(df)
    ids = {r["term"]: r["term_id"] for r in vocab.collect()}
    want = Counter()
    for words in lists:
        for i, x in enumerate(words):
            for j, y in enumerate(words):
                if i != j and abs(i - j) <= meaning.WINDOW and x in ids and y in ids:
                    want[ids[x], ids[y]] += 1
    rows = meaning.cooccurrences(df, vocab, 50).collect()
    assert len(rows) == len(want)
    assert {(r["a"], r["b"]): r["n"] for r in rows} == dict(want)
