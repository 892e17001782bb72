import bisect
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docloom.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit_decreasing(lengths, capacity):
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(free, x)
        if i < len(free):
            room = free.pop(i) - x
        else:
            n, room = n + 1, capacity - x
        if room:
            bisect.insort(free, room)
    return n


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_is_close_to_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = [
        rng.integers(1, 513, 3000), np.clip(rng.lognormal(4.5, 1, 5000), 1, 512).astype(int), rng.integers(170, 300, 2000),
        np.full(1000, 171), np.array([512, 1, 1]), np.array([], int),
    ][seed]
    counts = np.bincount(lengths, minlength=513)
    planned = P.plan(counts, 512)
    used = np.zeros(513, int)
    for chosen, times in planned:
        assert times > 0 and sum(chosen) <= 512
        for n in chosen:
            used[n] += times
    assert (used == counts).all()
    assert sum(t for _, t in planned) <= 1.01 * best_fit_decreasing(lengths.tolist(), 512) + 1


def test_nnls():
    rng = np.random.default_rng(1)
    a = rng.random((8, 20))
    truth = np.maximum(rng.normal(size=20), 0)
    x = P.nnls(a, a @ truth)
    assert (x >= 0).all() and np.abs(a @ x - a @ truth).max() < 1e-6
    x = P.nnls(a, -np.ones(8))
    assert not x.any()
    b = rng.normal(size=8)
    x = P.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (gradient <= 1e-6).all() and np.abs(gradient[x > 0]).max(initial=0) < 1e-6


def test_documents(spark):
    library = Tokenizer.from_file(PATH)
    rng = np.random.default_rng(2)
    words = ["alpha", "tionhai", "the", "Ünd", "x1,", "don't", "\n", "<|endoftext|>"]
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(0, 120, 120)] + [None, "", "long " * 1000] + ["same text"] * 60
    rows = [(i, t, "o") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string").repartition(5)
    packed = P.pack_documents(docs, PATH, 64, 1, ids=True).collect()
    by_sequence, by_doc = {}, {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, pieces in by_doc.items():
        want = library.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(want) // 64)
        for r in pieces:
            own = array("I", want[r["start"] : r["start"] + r["length"]]).tobytes()
            assert r["start"] == 64 * r["piece"] and bytes(r["ids"]) == own and r["ids_crc32"] == zlib.crc32(own)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert len(by_sequence) <= 1.02 * best_fit_decreasing([r["length"] for r in packed], 64) + 1
    joined = P.sequences(P.pack_documents(docs, PATH, 64, 1, ids=True)).collect()
    assert len(joined) == len(by_sequence) and sum(len(r["ids"]) for r in joined) == 4 * sum(r["length"] for r in packed)


def test_empty_table_and_odd_ids(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    rows = [(None, "a"), (None, None), (1, "b c"), (1, "b c"), (1, "d " * 100)]
    got = P.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH, 16).collect()
    spots = {(r["sequence_id"], r["offset"] + k) for r in got for k in range(r["length"])}
    assert len(spots) == sum(r["length"] for r in got) == 2 + 1 + 3 + 3 + 101
