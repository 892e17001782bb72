import hashlib
import random
from zlib import crc32

import pytest

from docloom.llm import periodic_runs as P


def brute_runs(words):
    """For each period, maximal stretches of words equal at that distance; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and (i, j + q) not in found:
                found[i, j + q] = q
            i = j + 1
    return sorted((i, j - i, q) for (i, j), q in found.items())


def brute_row(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def texts(seed=1, count=300):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        letters, words = "ab" if rng.random() < 0.5 else "abcdefghé", []
        while len(words) < rng.randint(0, 90):
            piece = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            words += piece * rng.choice([1, 1, 2, 4, 5, 9])
        out.append(rng.choice([" ", "\n", "\x0b "]).join(words))
    return out + [None, "", " \t\n", "a " * 5, "a " * 6, "x y " * 8, "a b " * 200]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 5])
def test_runs_of_random_words(alphabet):
    rng = random.Random(alphabet)
    for _ in range(400):
        words = [b"%d" % rng.randrange(alphabet) for _ in range(rng.randint(0, 60))]
        words += words[rng.randrange(len(words) + 1) :] * rng.randint(0, 5)
        assert P.find_runs(P.numbers(words)) == sorted(brute_runs(words), key=lambda r: (r[0], r[2]))


def test_suffixes():
    rng = random.Random(5)
    for _ in range(100):
        words = [rng.randrange(3) for _ in range(rng.randint(1, 40))]
        ids = P.np.array(words)
        order = P.suffix_order(ids).tolist()
        assert order == sorted(range(len(words)), key=lambda i: words[i:])
        for a, b, length in zip(order, order[1:], P.common_prefixes(ids, P.np.array(order)).tolist()[1:]):
            assert words[a : a + length] == words[b : b + length] and words[a + length : a + length + 1] != words[b + length : b + length + 1]


def test_query_against_brute_force(spark, tmp_path):
    from docloom.llm.queries import QUERIES

    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(3, "a b " * 9, "again")]
    spark.createDataFrame(rows, "doc_id long, text string, n_runs string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted((r["doc_id"], *[r[c] for c in names]) for r in out if r["doc_id"] != 3) == sorted(
        (i, *brute_row(i, t)) for i, t, _ in rows if i != 3
    )
    assert sum(r["doc_id"] == 3 for r in out) == 2
    assert sum(r["n_runs"] > 0 for r in out) > 100


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b " * 9), (None, None), (1, "")], "doc_id long, text string")
    out = P.describe_runs(docs, varied=True).orderBy("n_words").collect()
    assert [(r["n_runs"], r["period"]) for r in out] == [(0, None), (0, None), (1, 2)]
    assert P.describe_runs(docs.limit(0)).count() == 0


def test_very_long_texts():
    assert P.find_runs(P.numbers([b"a"] * 200_000)) == [(0, 200_000, 1)]
    words = [b"%d" % (k % 7_000) for k in range(100_000)]
    assert P.find_runs(P.numbers(words)) == [(0, 100_000, 7_000)]
    rng = random.Random(2)
    plain = [b"%d" % rng.randrange(50) for _ in range(60_000)]
    assert all(n >= max(6, 4 * q) for _, n, q in P.find_runs(P.numbers(plain)))


def test_collapse(spark):
    rows = [(1, "a  b", 5), (2, "x " + "a b " * 5 + "c", 6), (3, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    out = {r["doc_id"]: (r["text"], r["extra"]) for r in P.collapse_runs(docs).collect()}
    assert out == {1: ("a  b", 5), 2: ("x a b c", 6), 3: (None, 7)}
