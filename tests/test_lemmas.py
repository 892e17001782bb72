"""Suffix rules: learned, applied, and right on words that they have not seen."""

import random

import pytest

from docloom.operators import lemmas
from pyspark.sql import functions as F


def inflected(rng):
    """(token, lemma): regular plurals and past forms, and a few odd ones."""
    stem = "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) + rng.choice("klmnrt")
    kind = rng.randrange(5)
    if kind == 0:
        return stem + "ies", stem + "y"
    if kind == 1:
        return stem + "ss", stem + "ss"
    return [(stem, stem), (stem + "s", stem), (stem + "ing", stem)][kind - 2]


def pairs(count, seed=1):
    rng = random.Random(seed)
    return dict(inflected(rng) for _ in range(count))


def frame(spark, rows):
    return spark.createDataFrame(sorted(rows.items()), "token string, lemma string").repartition(3)


def brute_rules(rows, support, share):
    votes, totals = {}, {}
    for token, lemma in rows.items():
        same = 0
        while same < min(len(token), len(lemma)) and token[same] == lemma[same]:
            same += 1
        for more in range(min(same, lemmas.CONTEXT) + 1):
            key = (token[same - more :], lemma[same - more :])
            votes[key] = votes.get(key, 0) + 1
        for n in range(min(len(token), lemmas.LONGEST) + 1):
            ending = token[len(token) - n :]
            totals[ending] = totals.get(ending, 0) + 1
    best = {}
    for (ending, new), n in votes.items():
        if len(ending) <= lemmas.LONGEST and (ending not in best or (-n, new) < (-best[ending][1], best[ending][0])):
            best[ending] = (new, n)
    return {e: (new, n, totals[e]) for e, (new, n) in best.items() if n >= support and n >= share * totals[e]}


def test_rules_against_plain_counts(spark):
    rows = pairs(1500) | {"mice": "mouse", "geese": "goose", "a": "a", "": "", "children": "child"}
    got = {r["ending"]: (r["replacement"], r["support"], r["total"]) for r in lemmas.learn_rules(frame(spark, rows)).collect()}
    assert got == brute_rules(rows, lemmas.SUPPORT, lemmas.SHARE) and got["ies"][0] == "y"


def test_accuracy_on_unseen_words(spark):
    rows = pairs(6000)
    names = sorted(rows)
    known, held = {t: rows[t] for t in names[::2]}, names[1::2]
    rules, exceptions = lemmas.learn(frame(spark, known))
    docs = spark.createDataFrame([(i, held[i : i + 50]) for i in range(0, len(held), 50)], "doc_id long, tokens array<string>")
    right = total = 0
    for r in lemmas.apply_rules(docs, rules, exceptions).collect():
        right += sum(rows[t] == m for t, m in zip(r["tokens"], r["lemmas"]))
        total += len(r["tokens"])
    assert total == len(held) and right / total > 0.97


def test_exceptions_go_first_and_odd_rows(spark):
    rows = pairs(800) | {"mies": "mies", "news": "news"}
    rules, exceptions = lemmas.learn(frame(spark, rows))
    assert "mies" in {r["token"] for r in exceptions.collect()}
    docs = spark.createDataFrame(
        [(1, ["news", "xobies", "xobies", ""], "old"), (2, [], "old"), (3, None, "old")], "doc_id long, tokens array<string>, lemmas string"
    ).repartition(1)
    got = {r["doc_id"]: r["lemmas"] for r in lemmas.apply_rules(docs, rules, exceptions).collect()}
    assert got == {1: ["news", "xoby", "xoby", ""], 2: [], 3: None}
    # every training pair comes out as it went in
    all_tokens = spark.createDataFrame([(t, m, [t]) for t, m in rows.items()], "token string, lemma string, tokens array<string>")
    assert lemmas.apply_rules(all_tokens, rules, exceptions).where(F.get("lemmas", F.lit(0)) != F.col("lemma")).isEmpty()


@pytest.mark.parametrize("a,b,n", [("cities", "city", 3), ("a", "b", 0), ("", "x", 0), ("same", "same", 4), ("ab", "abc", 2)])
def test_common_prefix(spark, a, b, n):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(lemmas.common_prefix(F.col("a"), F.col("b"))).first()[0] == n


def test_vocabulary_pairs_read_the_texts_once(spark):
    """Words are stored: neither side of the join with stems goes back to the documents."""
    from docloom.plans import text_queries

    pairs = text_queries._vocabulary_pairs(spark, "/root/testdata/sf0.001")
    assert not any("documents.parquet" in name for name in pairs.inputFiles())
