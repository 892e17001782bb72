import math
import random
import zlib
from collections import Counter

import numpy as np

from docloom.llm import gru_lm as G
from docloom.llm.common import crc_mod
from pyspark.sql import functions as F


def network(seed=0):
    rng = np.random.default_rng(seed)
    net = G.Network.fresh(rng.integers(0, 50, G.CLASSES), rng.integers(0, 50, G.HEAD), seed)
    net.to_class += rng.normal(0, 0.3, net.to_class.shape).astype(np.float32)
    net.to_word += rng.normal(0, 0.3, net.to_word.shape).astype(np.float32)
    return net


def plain_score(net, ids):
    """One token at a time, straight from the definition."""
    h, total, previous = np.zeros(G.SIZE), 0.0, G.START
    sig = lambda v: 1 / (1 + np.exp(-v))
    n = G.SIZE
    for token in ids:
        x, u = net.inputs[previous].astype(float), h @ net.recur
        z, r = sig(x[:n] + u[:n]), sig(x[n : 2 * n] + u[n : 2 * n])
        h = (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :]) + z * h
        c = token // G.WIDTH if token < G.HEAD else token - G.HEAD + G.HEAD // G.WIDTH
        logits = h @ net.to_class + net.class_bias
        total += logits[c] - np.log(np.exp(logits).sum())
        if token < G.HEAD:
            inner = h @ net.to_word[c] + net.word_bias[c]
            total += inner[token % G.WIDTH] - np.log(np.exp(inner).sum())
        previous = token
    return total


def test_windows_carry_the_state():
    rng, net = np.random.default_rng(1), network()
    texts = [rng.integers(0, G.START, int(n)).astype(np.int16) for n in [1, 64, 65, 300, 128, 2, 63, 64, 1]]
    got = net.read(texts)
    assert np.allclose(got, [plain_score(net, t) for t in texts], rtol=1e-4)
    assert net.read([]).tolist() == []


def test_gradients():
    rng, net = np.random.default_rng(2), network(4)
    net = G.Network(*[a.astype(np.float64) for a in net.arrays()])
    block = rng.integers(0, G.START, (5, 3))
    block[3:, 2] = -1
    state, previous = rng.normal(size=(3, G.SIZE)), np.array([G.START, 5, 520])
    _, grads, _ = net.gradients(state, previous, block)
    for k, g in enumerate(grads):
        flat = np.flatnonzero(np.abs(g) > 1e-3)
        for at in rng.choice(flat, 6):
            sides = []
            for sign in (1, -1):
                arrays = [a.copy() for a in net.arrays()]
                arrays[k].ravel()[at] += sign * 1e-5
                sides.append(G.Network(*arrays).gradients(state, previous, block)[0])
            assert math.isclose((sides[0] - sides[1]) / 2e-5, g.ravel()[at], rel_tol=0.05, abs_tol=5e-3), (k, at)


def test_gradients_in_pieces_equal_those_at_once(monkeypatch):
    rng, net = np.random.default_rng(3), network(5)
    block = rng.integers(0, G.START, (9, 40))
    block[4:, 30:] = -1
    args = np.zeros((40, G.SIZE), np.float32), np.full(40, G.START), block
    loss, whole, state = net.gradients(*args)
    monkeypatch.setattr(G, "CACHED", 7)
    loss_in_pieces, pieces, same = net.gradients(*args)
    assert math.isclose(loss, loss_in_pieces, rel_tol=1e-5) and np.array_equal(state, same)
    assert all(np.allclose(a, b, rtol=1e-3, atol=1e-4) for a, b in zip(whole, pieces))


def test_training_helps():
    rng = np.random.default_rng(5)
    texts = [np.array(([1, 2, 3] if k % 2 else [40, 41, 530]) * int(rng.integers(5, 40))) for k in range(150)]
    counts = np.bincount(np.concatenate(texts), minlength=G.START)
    classes = np.concatenate([counts[: G.HEAD].reshape(-1, G.WIDTH).sum(1), counts[G.HEAD : G.START]])
    net = G.Network.fresh(classes, counts[: G.HEAD])
    trained = net
    for _ in range(6):
        trained = G.train(trained, texts, 0.02)
    assert trained.read(texts).sum() > 0.6 * net.read(texts).sum()


def test_probabilities_sum_to_one():
    net = network(7)
    h = np.random.default_rng(8).normal(size=(G.SIZE, 1)).astype(np.float32)
    total = sum(math.exp(net.log_probabilities(h, np.array([t]))[0]) for t in range(G.START))
    assert abs(total - 1) < 1e-4


def sample():
    rng = random.Random(6)
    vocab = [f"W{k}" for k in range(700)] + ["é", "The", "the", "THE,"]
    rows = [(i, " ".join(rng.choice(vocab) if rng.random() < 0.5 else "the" for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(900 + k, "ab" * k + " rare" + str(k)) for k in range(30)]
    return rows + [(500, None), (501, ""), (502, "\xa0\n\tunseen word"), (503, "the\n" * 40_000)]


def check_base(got, rows):
    words = {i: [*(t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split(), b""] for i, t in rows}
    train = Counter(w for i, t in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(train.values()), len(train)
    for r in got:
        tokens = words[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) and r["train_tokens"] == n
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(w in train for w in tokens))
        assert math.isclose(r["base_score"], sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_base_scores_with_few_and_with_all_words_local(spark, monkeypatch):
    rows = sample()
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(4)
    scores = []
    for local in (G.LOCAL, 560):
        monkeypatch.setattr(G.lexicon, "__defaults__", (local,))
        got = G.score_documents(docs, crc_mod(F.col("doc_id"), 7) != 2).collect()
        assert len(got) == len(rows)
        check_base(got, rows)
        scores.append({r["doc_id"]: r["score"] for r in got})
    assert all(math.isclose(scores[0][i], scores[1][i], rel_tol=1e-3) for i in scores[0])


def test_untrained_network_scores_like_counts(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = G.score_documents(docs, crc_mod(F.col("doc_id"), 7) != 2).collect()
    base, score = sum(r["base_score"] for r in got), sum(r["score"] for r in got)
    assert score > 1.1 * base


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert G.score_documents(none, F.lit(True)).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (1, "a"), (1, "a"), (2, None)], "doc_id long, text string")
    got = G.score_documents(rows, F.lit(True)).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 2, 2, 3] and {r["doc_id"] for r in got} == {None, 1, 2}
    unseen = G.score_documents(rows, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == 0 and r["held_out"] for r in unseen)


def test_every_training_row_gives_steps(spark, monkeypatch):
    """All learned rows reach the training, few or many, copies and repeated ids too; held-out rows do not."""
    seen = spark.sparkContext.accumulator(0)
    tokens = spark.sparkContext.accumulator(0)
    plain = G.train

    def noted(network, texts, rate=G.RATE):
        seen.add(len(texts))
        tokens.add(sum(map(len, texts)))
        return plain(network, texts, rate)

    monkeypatch.setattr(G, "train", noted)
    for rows in ([(3, "a b c")], sample(), [(3, "a b")] * 40 + [(None, "c")] * 3):
        learned = crc_mod(F.col("doc_id"), 7) != 2
        seen.value = tokens.value = 0
        out = G.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), learned)
        wanted = [(t or "").encode() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
        assert (seen.value, tokens.value) == (len(wanted), sum(len(t.split()) + 1 for t in wanted)) and len(wanted)
        assert out.count() == len(rows)


def test_scores_do_not_depend_on_the_session(spark, monkeypatch):
    """Neither shuffle partitions, Arrow batches nor the layout of the table change the network."""
    monkeypatch.setattr(G, "SHARD_TOKENS", 9_000)  # several shards
    docs = spark.createDataFrame(sample(), "doc_id long, text string")
    scores, names = [], ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = [spark.conf.get(n) for n in names]
    try:
        for values, parts in ((("4", "10000"), 3), (("64", "10000"), 3), (("5", "17"), 7)):
            for n, v in zip(names, values):
                spark.conf.set(n, v)
            got = G.score_documents(docs.repartition(parts), crc_mod(F.col("doc_id"), 7) != 2).collect()
            scores.append({r["doc_id"]: r["score"] for r in got})
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    for other in scores[1:]:
        assert all(math.isclose(scores[0][i], other[i], rel_tol=1e-5) for i in scores[0])


def test_trained_network_beats_the_untrained_one_on_held_out_texts(spark, monkeypatch):
    rng = random.Random(4)
    phrases = [[f"w{rng.randrange(300)}" for _ in range(6)] for _ in range(25)]
    rows = [(i, " ".join(w for _ in range(rng.randint(3, 12)) for w in rng.choice(phrases))) for i in range(700)]
    docs, learned = spark.createDataFrame(rows, "doc_id long, text string"), crc_mod(F.col("doc_id"), 7) != 2
    trained = G.score_documents(docs, learned).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
    monkeypatch.setattr(G.fit, "__defaults__", (0,))
    plain = G.score_documents(docs, learned).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
    assert trained[0] / trained[1] > plain[0] / plain[1] + 0.05
