"""URL filter: rules first, then a ratio of two character language models.

Two variable-order Markov models (contexts of zero to three characters, Witten-Bell
smoothing) are counted from the URLs that the rules allow and block. A URL without a rule
is judged by the difference of its two log-likelihoods per character, against a cut that is
calibrated on labelled URLs the models have not seen. DataFrame functions only.

Characters are folded to 63 symbols: letters without case, digits, common punctuation, and one for each of
the larger scripts. A URL is cut into all its grams of four symbols inside its row, in linear time; rows carry a number and
a gram, never the URL. Shorter grams are the ends of longer ones and are counted from them, and the value of a
gram of four is worked out once, so positions meet one table, which is broadcast while its counted rows fit.
Logarithms are held as whole millionths, so sums do not depend on the order of rows.

Edge cases: a null URL or one without ``://`` has an empty host and path, no rule, and is
scored as the empty text; repeated rows are judged alike; without labelled URLs every score
is 0 and the cut is 0, which allows; an empty table gives an empty result; columns of the
input are carried through, but for those named like a result or with the prefix ``_u_`` of
working columns, which are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import fold_ascii
from docloom.runtime import broadcast_bounded, materialize

ORDER = 4
PUNCTUATION = "/.?&=_%#+~:@,;!-"  # the hyphen last, as character classes need it
# capitals are free: they stand for the letters of a script beyond ASCII
SCRIPTS = {"L": "IsLatin", "G": "IsGreek", "C": "IsCyrillic", "A": "IsArabic", "H": "IsHebrew", "Z": "IsHan", "N": "IsHangul", "K": "IsHiragana"}
BEYOND, OTHER, PAD = "O", "*", "^"
SYMBOLS = 26 + 10 + len(PUNCTUATION) + len(SCRIPTS) + 3
MICRO = 1_000_000
# (verdict, rule): host suffix, then path prefix
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = fold_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path that starts with its path."""
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later, longer ones win
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def fold(text: Column) -> Column:
    """Text in the symbols of the models."""
    low = F.regexp_replace(fold_ascii(text), rf"[\x00-\x7f&&[^a-z0-9{PUNCTUATION}]]", OTHER)
    wide = low
    for symbol, script in SCRIPTS.items():
        wide = F.regexp_replace(wide, rf"[\p{{{script}}}&&[^\x00-\x7f]]", symbol)
    wide = F.regexp_replace(wide, r"[^\x00-\x7f]", BEYOND)
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(wide)


def _positions(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, gram): the symbols at and before every character, and the end, of the padded text."""
    padded = F.concat(F.lit(PAD * (ORDER - 1)), fold(F.col("_u_text")), F.lit(PAD))
    # a look-ahead finds overlapping grams, in one pass over the text
    return texts.select(*keys, F.explode(F.regexp_extract_all(padded, F.lit(f"(?=(.{{{ORDER}}}))"), F.lit(1))).alias("gram"))


def _ends(gram: str) -> Column:
    """The grams of 1 to ``ORDER`` symbols at the end of a longest one."""
    return F.array(*[F.substring(gram, ORDER - n + 1, n) for n in range(1, ORDER + 1)])


def fit(labelled: DataFrame) -> DataFrame:
    """(_u_text, _u_ok) to (gram, lr, bow): log ratio of a gram and back-off ratio of a context.

    ``lr`` is ln P(last | rest) under the accepted model minus the same under the rejected
    one; ``bow`` is the difference of the logarithms of the weights that Witten-Bell gives
    to shorter contexts. Both in millionths.
    """
    longest = (
        _positions(labelled, "_u_ok")
        .groupBy("gram")
        .agg(F.count_if("_u_ok").alias("na"), F.count_if(~F.col("_u_ok")).alias("nr"))
    )
    grams = longest.select("na", "nr", F.explode(_ends("gram")).alias("gram")).groupBy("gram")
    grams = materialize(grams.agg(F.sum("na").alias("na"), F.sum("nr").alias("nr")), "url-grams")
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    contexts = (
        grams.groupBy(context.alias("ctx"))
        .agg(
            F.sum("na").alias("ca"), F.sum("nr").alias("cr"),
            F.count_if(F.col("na") > 0).alias("ta"), F.count_if(F.col("nr") > 0).alias("tr"),
        )
    )
    joined = grams.withColumn("ctx", context).join(contexts, "ctx")

    def smoothed(n, c, t, lower):
        return F.when(F.col(c) + F.col(t) == 0, lower).otherwise((F.col(n) + F.col(t) * lower) / (F.col(c) + F.col(t)))

    uniform = F.lit(1.0 / SYMBOLS)
    level = joined.where(F.length("gram") == 1).select(
        "gram", smoothed("na", "ca", "ta", uniform).alias("pa"), smoothed("nr", "cr", "tr", uniform).alias("pr")
    )
    levels = [level]
    for n in range(2, ORDER + 1):
        shorter = level.select(F.col("gram").alias("tail"), F.col("pa").alias("qa"), F.col("pr").alias("qr"))
        level = (
            joined.where(F.length("gram") == n)
            .withColumn("tail", F.expr("substring(gram, 2)"))
            .join(shorter, "tail")
            .select(
                "gram", smoothed("na", "ca", "ta", F.col("qa")).alias("pa"), smoothed("nr", "cr", "tr", F.col("qr")).alias("pr")
            )
        )
        levels.append(level)
    ratios = reduce(DataFrame.unionByName, levels).select("gram", _micro(F.log(F.col("pa") / F.col("pr"))).alias("lr"))

    def weight(c, t):
        return F.when(F.col(c) + F.col(t) == 0, F.lit(1.0)).otherwise(F.col(t) / (F.col(c) + F.col(t)))

    backs = contexts.select(
        F.col("ctx").alias("gram"), _micro(F.log(weight("ca", "ta") / weight("cr", "tr"))).alias("bow")
    )
    return materialize(ratios.join(backs, "gram", "full_outer"), "url-model")


def _micro(value: Column) -> Column:
    return F.round(value * MICRO).cast("long")


def gram_values(grams: DataFrame, model: DataFrame) -> DataFrame:
    """(gram) of the longest kind to (gram, v): its log ratio, by the shortened contexts where it was not counted."""
    parts = grams.select("gram", F.posexplode(_ends("gram")).alias("i", "end"))
    found = parts.join(model.withColumnRenamed("gram", "end"), "end", "left").groupBy("gram").agg(
        *[F.max(F.when(F.col("i") == n - 1, F.col("lr"))).alias(f"lr{n}") for n in range(1, ORDER + 1)]
    )
    # the contexts: what stands before the last symbol; the shortest is empty
    contexts = grams.select(
        "gram", F.posexplode(F.array(*[F.substring("gram", ORDER - n, n) for n in range(ORDER)])).alias("i", "context")
    )
    backs = contexts.join(model.withColumnRenamed("gram", "context"), "context", "left").groupBy("gram").agg(
        *[F.max(F.when(F.col("i") == n, F.col("bow"))).alias(f"bow{n}") for n in range(ORDER)]
    )
    value, backed = [], F.lit(0)
    for n in range(ORDER, 0, -1):
        value.append(backed + F.col(f"lr{n}"))
        backed = backed + F.coalesce(f"bow{n - 1}", F.lit(0))
    # a symbol never seen: both models are uniform
    return found.join(backs, "gram").select("gram", F.coalesce(*value, backed).alias("v"))


def score_texts(texts: DataFrame, model: DataFrame) -> DataFrame:
    """(_u_id, _u_text), each once, to (_u_id, score): nats per character, positive for accepted-like."""
    rows = _positions(texts, "_u_id")
    values = materialize(gram_values(rows.select("gram").distinct(), model), "url-values")
    return (
        rows.join(broadcast_bounded(values, values.count()), "gram")
        .groupBy("_u_id")
        .agg((F.sum("v") / F.count("*") / MICRO).alias("score"))
    )


def calibrate(scored: DataFrame) -> float:
    """The cut on (score, _u_ok) with the best balanced accuracy, to a hundredth of a nat.

    Scores fall into at most 2,001 bins, so what is ordered in one task has a fixed bound.
    """
    bins = scored.groupBy(F.floor(F.greatest(F.least("score", F.lit(10.0)), F.lit(-10.0)) * 100).alias("bin")).agg(
        F.count_if("_u_ok").alias("good"), F.count_if(~F.col("_u_ok")).alias("bad")
    )
    rows = sorted(tuple(r) for r in bins.collect())
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    best, cut, lost, caught = -1.0, 0.0, 0, 0
    for at, g, b in rows:
        quality = (good - lost) / good + caught / bad
        if quality > best:
            best, cut = quality, at / 100
        lost, caught = lost + g, caught + b
    return cut


def filter_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score.

    A fifth of the labelled texts (by their own crc32) calibrates, the others are counted.
    """
    verdicts = {rule: verdict for verdict, rule in rules}
    results = ("host", "path", "rule", "verdict", "score")
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c == url or c not in results and not c.startswith("_u_")])
    host, path = host_and_path(F.col(url))
    judged = pages.withColumns({"host": host, "path": path}).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    after = F.instr(F.col(url), "://")
    judged = judged.withColumn("_u_text", F.when(after > 0, F.substr(F.col(url), after + 3)).otherwise(F.lit("")))
    judged = judged.withColumn("_u_text", F.coalesce("_u_text", F.lit("")))
    allowed = F.col("rule").isin([r for r, v in verdicts.items() if v == "allow"])
    # one row per text: a URL that is repeated a million times is read once
    texts = judged.groupBy("_u_text").agg(F.max(F.when(F.col("rule").isNotNull(), allowed)).alias("_u_ok"))
    # as many files as cores: each row becomes a hundred
    cores = pages.sparkSession.sparkContext.defaultParallelism
    texts = materialize(texts.repartition(cores).withColumn("_u_id", F.monotonically_increasing_id()), "url-texts")
    labelled = texts.where(F.col("_u_ok").isNotNull())
    held = F.crc32(F.col("_u_text").cast("binary")) % 5 == 0
    model = fit(labelled.where(~held))
    scored = materialize(score_texts(texts, model).join(texts, "_u_id"), "url-scores")
    cut = calibrate(scored.where(F.col("_u_ok").isNotNull() & held))
    by_rule = F.when(F.col("rule").isNotNull(), F.when(allowed, "allow").otherwise("block"))
    return (
        judged.join(scored.select("_u_text", "score"), "_u_text", "left")
        .withColumn("verdict", F.coalesce(by_rule, F.when(F.col("score") >= cut, "allow").otherwise("block")))
        .drop("_u_text")
    )
