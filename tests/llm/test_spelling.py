import random
import re
from collections import Counter
from zlib import crc32

import pytest

from docloom.llm import spelling as S


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    total = Counter()
    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    words = {w: n for w, n in total.items() if n >= 5 and len(w) >= 6}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, words[w], len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return sorted(out)


def vocabulary(rng, count, letters="abé"):
    words = set()
    while len(words) < count:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))
        words.add(w)
        if rng.random() < 0.5:
            at = rng.randrange(len(w))
            words.add(w[:at] + rng.choice(["", "z", "zz", w[at] * 2, "ÿ"]) + w[at + rng.randint(0, 1) :])
    return sorted(words)


def sample(seed=1):
    rng = random.Random(seed)
    words = vocabulary(rng, 260)
    weights = [rng.choice([1, 2, 15, 150]) for _ in words]
    docs = []
    for i in range(200):
        picked = rng.choices(words, weights, k=rng.randint(0, 400))
        docs.append((i, rng.choice(["1", " ", "_"]).join(w if rng.random() < 0.8 else w[0].upper() + w[1:] for w in picked)))
    long_word = "ab" * 400
    return docs + [(500, None), (501, ""), (None, "abcdefg " * 5), (3, " ".join(words)), (502, f"{long_word} {long_word}x " * 6), (502, (long_word + " ") * 60)]


@pytest.mark.parametrize("letters", ["ab", "abcdé", "aaab"])
def test_scan(letters):
    rng = random.Random(len(letters))
    for _ in range(150):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 30))})
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if edits(words[i], words[j]) == 1]
        assert list(S.scan(words)) == want


@pytest.mark.parametrize("block", [8192, 3])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, block):
    from docloom.llm.queries import QUERIES

    monkeypatch.setattr(S, "BLOCK", block)
    docs = sample()
    rows = [(i, t, "x") for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    got = sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in out.collect())
    want = brute(docs)
    assert got == want
    assert sum(r[3] is not None for r in want) > 40 and any(r[3] not in (None, r[5]) for r in want)


def test_without_slips_and_empty(spark):
    docs = spark.createDataFrame([(k, "colour " * 30 + "color colours " * 5 + "x" * 5) for k in range(2)], "doc_id long, text string")
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["root"]) for r in S.group_variants(docs).collect()}
    assert out == {"colour": (60, 1, None, "colour"), "colours": (10, 1, "colour", "colour")}
    assert S.group_variants(docs.limit(0)).count() == 0
