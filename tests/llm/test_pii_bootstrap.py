import hashlib
import random
import re
from collections import defaultdict

import pytest

from docloom.llm import pii_bootstrap as P

CONTRACT = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(number)):
            d = int(c) * (1 + i % 2)
            total += d - 9 if d > 9 else d
        return 12 <= len(number) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(number) <= 15


def base(text):
    return sorted(
        (m.start(), order, m.end(), kind)
        for order, (kind, pattern) in enumerate(CONTRACT)
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    )


def seed_kind(text):
    return next((k for k, p in CONTRACT if re.fullmatch(p, text) and passes(k, text)), None)


def shape(text):
    if "@" in text:
        return "at"
    if re.fullmatch(r"[0-9A-Fa-f]+([.:][0-9A-Fa-f]+){2,}", text) and re.search("[0-9]", text):
        return "dotted"
    return "digits" if re.fullmatch(r"\+?[0-9][0-9 ().-]*", text) else None


def mentions(text):
    found = list(re.finditer(P.MENTION, text or ""))
    out = []
    for i, m in enumerate(found):
        before = (text[found[i - 1].end() if i else 0 : m.start()])[-P.WINDOW :]
        after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)][: P.WINDOW]

        def words(piece):
            piece = "".join(c.lower() if "A" <= c <= "Z" else c for c in piece)
            return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[0-9]", "0", piece))

        left, right = ["^", "^"] + words(before), words(after) + ["$"]
        own = re.sub("^[^A-Za-z0-9+]+", "", m.group())
        form = shape(own)
        inst = re.sub("[^0-9]", "", own) if form == "digits" else own.lower()
        kind = seed_kind(own)
        holds = any(re.search(p, inst) for _, p in CONTRACT[:2])
        if form and (kind or not holds):
            contexts = (f"{left[-2]} {left[-1]} _", f"{left[-1]} _ {right[0]}")
            out.append((m.end() - len(own), m.end(), inst, kind, form, contexts))
    return out


def bootstrap(texts):
    """Spans of each text, and scores, with plain dictionaries."""
    read = [mentions(t) for t in texts]
    pairs = {(c, m[2], m[3], m[4]) for ms in read for m in ms for c in m[5]}
    total, seeds, edges = defaultdict(int), defaultdict(int), set()
    for context, inst, kind, form in pairs:
        for k in P.FITS[form]:
            total[context, k] += 1
            seeds[context, k] += kind == k
            if kind is None:
                edges.add((context, inst, k))
    scores, last = defaultdict(float), 0.0
    for _ in range(P.ROUNDS):
        gained = defaultdict(float)
        for context, inst, k in edges:
            gained[context, k] += scores[inst, k]
        miss = defaultdict(lambda: 1.0)
        for context, inst, k in edges:
            support = seeds[context, k] + gained[context, k]
            confidence = support / (total[context, k] + 1)
            if support >= P.SUPPORT and confidence >= P.TRUSTED:
                miss[inst, k] *= 1 - confidence
        scores = defaultdict(float, {key: round(1 - m, 9) for key, m in miss.items()})
        if sum(scores.values()) - last < P.MOVED:
            break
        last = sum(scores.values())
    best = {}
    for (inst, k), s in scores.items():
        if s >= P.ACCEPT:
            best[inst] = max(best.get(inst, (0, -9)), (s, -P.KINDS.index(k)))
    out = []
    for text, ms in zip(texts, read):
        known = base(text)
        more = [(m[0], -best[m[2]][1], m[1], P.KINDS[-best[m[2]][1]]) for m in ms if m[3] is None and m[2] in best]
        out.append(sorted(known + [s for s in more if not any(b[0] < s[2] and s[0] < b[2] for b in known)]))
    return out


def number(rng, valid=True):
    digits = [rng.randrange(10) for _ in range(rng.choice([11, 15, 15, 18]))]
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    check = -total % 10 if valid else (1 - total) % 10
    return "".join(map(str, digits)) + str(check)


def sample(seed=4):
    rng = random.Random(seed)
    words = ["card:", "no", "mail", "call", "to", "from", "é", "Über", "server", "at", "the", "x😀"]

    def octets():
        return ".".join(str(rng.choice([0, 7, 99, 255, 256, 1000, "001"])) for _ in range(rng.choice([3, 4, 4, 4, 5])))

    def thing():
        return rng.choice([
            lambda: number(rng), lambda: number(rng, False), lambda: octets(),
            lambda: " ".join([n[i : i + 4] for n in [number(rng)] for i in range(0, len(n), 4)]),
            lambda: f"a{rng.randrange(30)}.b@host-{rng.randrange(9)}.example.org", lambda: f"user{rng.randrange(9)}@intranet",
            lambda: "a@b.c_x%d@y.org", lambda: "a@b@c.d-", lambda: "--12 34-56 7890 1234 5", lambda: f"+1 ({rng.randrange(900)}) 555-{rng.randrange(9999)}",
            lambda: "+49 (30) 1234 56 78 --", lambda: "+1-", lambda: str(rng.randrange(10**7)), lambda: "AB12345 6789 0123 4567", lambda: "1.2.3.4.5.6.7.8.9",
        ])()

    texts = []
    for _ in range(500):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(thing() if rng.random() < 0.35 else rng.choice(words))
        texts.append("".join(p + rng.choice([" ", " ", "\n", ", ", ""]) for p in parts))
    # a context of its own in which most numbers are cards, and some unknown ones
    for k in range(40):
        texts.append(f"w{k} please charge card {number(rng, valid=k % 8 != 0)} on w{k % 7}")
    return texts + [None, "", *runs(2_000)]


def runs(n):
    """Texts that make the plain expressions slow."""
    return ["a" * n, "1" * n, "1." * n, "a." * n + "@", "x@" * n + "y.z", "+1" + "(" * n, "1.2.3.4 " * n]


def rows(texts):
    return [(i, t, "w") for i, t in enumerate(texts)]


def test_query_against_plain_python(spark, tmp_path):
    from docloom.llm.queries import QUERIES

    texts = sample()
    spark.createDataFrame(rows(texts), "doc_id long, text string, spans string").repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op11_pii_bootstrap"](spark, str(tmp_path)).collect()
    want = bootstrap(texts)
    assert len(out) == len(texts)
    context = 0
    for r in out:
        known, spans = base(texts[r["doc_id"]]), want[r["doc_id"]]
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[3] == k for s in known) for k in P.KINDS], texts[r["doc_id"]][:300]
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in known)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), texts[r["doc_id"]][:300]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans), texts[r["doc_id"]][:300]
        context += len(spans) - len(known)
    assert context >= 5


def test_patterns_discover_unseen_identifiers(spark):
    rng = random.Random(1)
    texts = [f"w{k} invoice to {'user%d@intranet' % k if k % 10 == 0 else 'user%d@example.org' % k} w{k}" for k in range(60)]
    texts += [f"w{k} version of 12345{k} w{k}" for k in range(20)] + [f"w{k} version of {number(rng)} w{k}" for k in range(5)]
    texts += ["elsewhere user10@intranet, again", "elsewhere user99@intranet, again"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = P.extract(docs)
    spans = {r["doc_id"]: [(s["kind"], s["by"], texts[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"]] for r in found.spans.collect()}
    assert spans[10] == [("email", "context", "user10@intranet")] and spans[11] == [("email", "base", "user11@example.org")]
    assert spans[85] == [("email", "context", "user10@intranet")] and spans[86] == []
    # a context that mostly holds other numbers is not trusted
    assert all(not spans[k] for k in range(60, 80)) and all(len(spans[k]) == 1 for k in range(80, 85))
    top = found.patterns.orderBy("confidence", ascending=False).first()
    assert top["context"] == "invoice to _" and top["kind"] == "email" and top["confidence"] > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a@b.c"), (None, "a@b.c d@e.f"), (1, None), (1, "1.2.3.4")], "doc_id long, text string")
    out = sorted((r["doc_id"] or 0, len(r["spans"])) for r in P.extract(docs).spans.collect())
    assert out == [(0, 1), (0, 2), (1, 0), (1, 1)]
    assert P.extract(docs.limit(0)).spans.count() == 0


@pytest.mark.parametrize("count", [0, 1, 255, 256, 257, 3000])
def test_running(spark, count):
    values = [k % 7 for k in range(count)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(P.running(P.F.col("v")).alias("s")).first()
    assert row["s"] == [sum(values[: k + 1]) for k in range(count)]


def test_very_long_runs(spark):
    docs = spark.createDataFrame(list(enumerate(runs(100_000))), "doc_id long, text string")
    found = {r["doc_id"]: r["n"] for r in P.extract(docs).spans.selectExpr("doc_id", "size(spans) AS n").collect()}
    assert found == {0: 0, 1: 0, 2: 25_000, 3: 0, 4: 1, 5: 0, 6: 100_000}
