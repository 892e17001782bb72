import math
import random
import re
import zlib
from collections import Counter, defaultdict

import regex

from docloom.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path, rest


def rule_of(host, path):
    best = None
    for _, rule in U.RULES:
        name, _, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
            best = rule if best is None or len(rule) > len(best) else best
    return best


def folded(text):
    out = []
    for c in text:
        if c.isascii():
            out.append(c.lower() if c.isalnum() or c in U.PUNCTUATION else U.OTHER)
        else:
            out.append(next((k for k, v in U.SCRIPTS.items() if regex.match(rf"\p{{{v}}}", c)), U.BEYOND))
    return "^^^" + "".join(out) + "^"


def brute(urls):
    """The models as nested dictionaries, straight from the definitions."""
    verdicts = {r: v == "allow" for v, r in U.RULES}
    label = {}
    for u in urls:
        host, path, text = parts(u)
        rule = rule_of(host, path)
        label[text] = verdicts[rule] if rule else label.get(text)
    held = {t: zlib.crc32(t.encode()) % 5 == 0 for t in label}
    counts = {ok: [defaultdict(Counter) for _ in range(U.ORDER)] for ok in (True, False)}
    for t, ok in label.items():
        if ok is not None and not held[t]:
            s = folded(t)
            for i in range(3, len(s)):
                for k in range(U.ORDER):
                    counts[ok][k][s[i - k : i]][s[i]] += 1

    def probability(ok, context, c):
        p = 1 / U.SYMBOLS
        for k in range(len(context) + 1):
            seen = counts[ok][k].get(context[len(context) - k :])
            if seen:
                p = (seen[c] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    def score(t):
        s = folded(t)
        values = [math.log(probability(True, s[i - 3 : i], s[i]) / probability(False, s[i - 3 : i], s[i])) for i in range(3, len(s))]
        return sum(values) / len(values)

    return {t: score(t) for t in label}, label, held


def urls(n=400):
    rng = random.Random(8)
    hosts = ["a.example.org", "EXAMPLE.ORG", "x.com", "shop.Net", "sub.example.com", "org", "notorg", "casino.net", "com"]
    paths = ["/fr/1", "/de/2", "/es/x", "/en/1x", "/en/2", "", "/", "?q=/fr/", "#f", "/fr", "/é", "/κόσμος/мир^ 世界/카", "/👍\u0558", "/es/x?utm=1", "/de/99/" + "p" * 50]
    made = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.randint(0, 300) or ''}" for _ in range(n)]
    return made + [None, "", "no scheme", "://", "a://b://c/fr/", "http://x.com/fr/\nline"] + made[:20]


def test_against_brute_force(spark):
    rows = [(i, u, "h") for i, u in enumerate(urls())] + [(None, "http://a.org/", "h"), (3, "http://b.com/de/", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, score string").repartition(4)
    out = U.filter_urls(pages).collect()
    want, label, held = brute([u for _, u, _ in rows])
    cut = U.calibrate(spark.createDataFrame([(want[t], label[t]) for t in want if label[t] is not None and held[t]], "score double, _u_ok boolean"))
    assert len(out) == len(rows)
    for r in out:
        host, path, text = parts(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule_of(host, path))
        assert abs(r["score"] - want[text]) < 2e-5, r["url"]
        if r["rule"]:
            assert r["verdict"] == {rule: v for v, rule in U.RULES}[r["rule"]]
        elif abs(want[text] - cut) > 1e-4:
            assert r["verdict"] == ("allow" if want[text] >= cut else "block")


def test_calibration_finds_the_best_cut(spark):
    rows = [(x / 10, x >= 3) for x in range(-20, 20)] + [(-1.5, True)]
    assert U.calibrate(spark.createDataFrame(rows, "score double, _u_ok boolean")) == 0.3
    assert U.calibrate(spark.createDataFrame([(1.0, True)], "score double, _u_ok boolean")) == 0.0


def test_without_labels_and_without_rows(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a"), (2, None)], "page_id long, url string")
    assert {(r["verdict"], r["score"]) for r in U.filter_urls(pages).collect()} == {("allow", 0.0)}
    assert U.filter_urls(pages.limit(0)).count() == 0


def test_no_python_on_the_path(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a")], "page_id long, url string")
    plan = U.filter_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Eval|MapIn|Pandas|Arrow", plan)


def test_very_long_url(spark):
    """Linear in the length: a URL of a million characters next to short ones."""
    rows = [(i, u) for i, u in enumerate(urls())] + [(-1, "http://y.net/" + "a1/é" * 250_000)]
    out = {r["page_id"]: r for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(out) == len(rows) and out[-1]["score"] is not None and out[-1]["rule"] is None
