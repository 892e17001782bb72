import hashlib
import random
import re

from docloom.llm import secret_scan as S
from pyspark.sql import functions as F

PATTERNS = [
    (r"(?:(?i:(password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    (r"AKIA[A-Z0-9]+", 0, 16),
    (r"[0-9a-f]+", 0, 32),
]


def brute(text):
    """The contract's kinds with their loose patterns and the lengths applied afterwards."""
    found = []
    for order, (pattern, group, least) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), order, m.end(), S.BASE[order].kind))
    return sorted(found)


def sample():
    rng = random.Random(3)
    bits = [
        "token=secret:abcdefgh12", "PassWord : 'abcdefgh'", "api_key==abcdefg", "apikey=\"abcdefghij\"", "AKIA" + "Q" * 12,
        "AKIAAKIA" + "Z" * 9, "AKIA" + "Q" * 11, "0123456789abcdef" * 2, "0123456789abcdef" * 2 + "G", "f" * 31, "\n", "é😀", " ",
        "ghp_" + "a" * 36, "secret", ":", "=", "xtokenx", "-----BEGIN RSA PRIVATE KEY-----", "tok", "ken=12345678", "prose",
    ]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", ","]) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    return texts + [None, "", "x" * 300_000 + " token=abcdefgh1 " + "y" * 10]


def test_against_brute_force(spark):
    rows = [(i, t, "w") for i, t in enumerate(sample())] + [(None, "token=abcdefgh1", "w"), (0, "secret=abcdefgh1", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _s_kinds string").repartition(5)
    out = S.scan(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        base = [tuple(s[k] for k in ("start", "ord", "end", "kind")) for s in r["spans"] if s["ord"] < 3]
        assert base == brute(r["text"]), r["text"][:200]
        for s in r["spans"]:
            assert re.search(S.RULES[s["ord"]].pattern, r["text"][s["start"] : s["end"]])
    kinds = {s["kind"] for r in out for s in r["spans"]}
    assert {"assign", "access", "hex", "github", "pem"} <= kinds


def test_queries_hold_for_every_match():
    assert S.trigram_query(r"[0-9a-f]{32,}") is True
    assert S.trigram_query("ab") is True
    assert S.grams_in(S.trigram_query("AKIA[A-Z0-9]{12,}")) == {"aki", "kia"}
    query = S.trigram_query(S.BASE[0].pattern)

    def holds(q, text):
        if isinstance(q, str):
            return q in text
        return (all if q[0] == "and" else any)(holds(p, text) for p in q[1])

    for text in sample()[:400]:
        if any(s[1] == 0 for s in brute(text)):
            assert holds(query, text.lower())


def test_mask_and_join(spark):
    docs = spark.createDataFrame([(1, "a token=ghp_" + "a" * 36 + " é AKIA" + "Q" * 12 + "."), (2, None), (3, "")], "doc_id long, text string")
    docs = docs.withColumns({"m": F.col("text"), "n": F.lit(-1).cast("long")})
    found = S.scan(docs).withColumn("j", S.joined(F.col("spans")))
    out = S.mask(found, "m", "n").orderBy("doc_id").collect()
    assert [r["n"] for r in out] == [len(out[0]["m"]), -1, -1]
    assert out[0]["m"] == "a [SECRET] é [SECRET]." and out[1]["m"] is None and out[2]["m"] == ""
    assert out[0]["j"] == "assign:2:48,github:8:48,hex:12:48,access:51:67"
    assert out[2]["j"] == ""
    assert S.scan(docs.limit(0)).count() == 0


def test_mask_of_many_spans(spark):
    rows = list(enumerate(sample()))
    for r in S.mask(S.scan(spark.createDataFrame(rows, "doc_id long, text string")), "text").collect():
        want, at = "", 0
        for s in r["spans"]:
            if s["start"] >= at:
                want += (rows[r["doc_id"]][1][at : s["start"]]) + S.MASK
            at = max(at, s["end"])
        assert r["text"] == (rows[r["doc_id"]][1] if not r["spans"] else want + rows[r["doc_id"]][1][at:])


def test_query_digest(spark, tmp_path):
    from docloom.llm.queries import QUERIES

    spark.createDataFrame([(i, t) for i, t in enumerate(sample())], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op10_secret_scan"](spark, str(tmp_path)).collect():
        want = brute(sample()[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w[1] == o for w in want) for o in range(3)]
