"""Quality rules whose thresholds come from the data.

Per text: words, characters in words, symbols, repeated lines, words in repeated five-word
windows. Each ratio goes into a quantile sketch per (language, source) and size of text, because short
texts vary more: counts of log-linear buckets (the seven leading bits of the ratio in thousandths), so two
sketches merge by adding counts and no quantile is off by more than one part in 64. A text fails when a ratio
lies beyond the fence q75 + reach * (q75 - q25) of its group by more than ``reach`` occurrences, or below the
mirrored one for word length; no cutoff on a ratio is fixed. A group with fewer than ``least`` texts uses the
merged sketch of its language, and that failing the merged sketch of everything; likewise the spread q75 - q25
of a group without any. A size with fewer than ``least`` texts in all has no fences.

Sketches are one aggregation with map-side combining: a source that holds a third of the rows
adds at most a few thousand buckets. Integer arithmetic throughout, so results do not depend on
the order of rows.

Edge cases: null and empty texts have no words and fail the base rule; null languages and
sources form groups of their own; rows are judged one by one, so repeated ids stay apart;
columns of the input are carried through, except that those named like a result are replaced and
those with the prefix ``_q_`` of working columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import ODD, mix, texts_of
from docloom.runtime import BROADCAST_BYTES, materialize

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
INSIDE = bytes(range(0x80, 0xC0))  # bytes that continue a code point
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
WINDOW = 5
# ratio: (numerator, denominator, also a lower fence)
RATIOS = {
    "word_length": ("word_chars", "n_words", True),
    "symbols": ("n_symbols", "n_words", False),
    "dup_lines": ("n_dup_lines", "n_lines", False),
}
SIZES = (32, 128, 512)  # words from which a text belongs to the next size
SIZE = "_q_size"
REACH = 6
LEAST = 50


def measure(text: bytes) -> tuple[int, ...]:
    """The measures of one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text.translate(None, INSIDE + SPACE)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words inside a five-word window that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        window = mix(window * ODD + ids[k : k + n])
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    starts = np.zeros(n, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k : k + n] |= starts
    return int(covered.sum())


def add_measures(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with the measures of the text, and with the text itself if asked for. Map-only.

    Only the text is sent to Python, and only the measures come back; all other columns stay where they are.
    """
    gone = MEASURES if keep_text else (text_col, *MEASURES)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in gone and not c.startswith("_q_")]

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = np.array([measure(t) for t in texts_of(column)], np.int64).reshape(-1, len(MEASURES))
            yield pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(MEASURES))], names=list(MEASURES))

    # not deterministic for the planner: else a filter on a measure would have every text measured once more
    measured = F.arrow_udf(run, ", ".join(f"{m} long" for m in MEASURES)).asNondeterministic()(F.col(f"`{text_col}`"))
    return docs.select(*others, measured.alias("_q_measures")).select(*others, "_q_measures.*")


def _shift(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - 7, F.lit(0))


def _bucket(value: Column) -> Column:
    """The value with all but its seven leading bits cleared."""
    return F.call_function("shiftleft", F.call_function("shiftright", value, _shift(value)), _shift(value))


def _bucket_end(bucket: Column) -> Column:
    """The largest value of a bucket."""
    return bucket + F.call_function("shiftleft", F.lit(1).cast("long"), _shift(bucket)) - 1


def _ratio(name: str) -> Column:
    above, below, _ = RATIOS[name]
    return F.expr(f"{above} * 1000 div greatest({below}, 1)")


def text_size() -> Column:
    """0 for the shortest texts, then 1, 2 ..."""
    return reduce(Column.__add__, [(F.col("n_words") >= n).cast("int") for n in SIZES])


def sketch(measured: DataFrame, keys: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Sketches of every ratio per key and size: (keys, size, ratio, bucket, n), over texts with a word."""
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), _bucket(_ratio(r)).alias("bucket")) for r in RATIOS]))
    rows = measured.where("n_words > 0").select(*keys, text_size().alias(SIZE), pairs.alias("_q_pair"))
    return rows.groupBy(*keys, SIZE, "_q_pair.ratio", "_q_pair.bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, by adding counts."""
    return sketches.groupBy(*keys, SIZE, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, size, ratio, total, q25, q75): the first value of the one bucket, the last of the other.

    A sketch has a few thousand buckets at most.
    """
    from pyspark.sql import Window

    group = Window.partitionBy(*keys, SIZE, "ratio")
    seen = sketches.withColumn("seen", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    at = {q: F.min(F.when(F.col("seen") * 4 >= F.col("total") * q, F.col("bucket"))) for q in (1, 3)}
    found = seen.groupBy(*keys, SIZE, "ratio").agg(F.max("total").alias("total"), at[1].alias("q25"), at[3].alias("q75"))
    found = found.withColumn("q75", _bucket_end(F.col("q75")))
    return found.withColumn("spread", F.col("q75") - F.col("q25"))


def thresholds(sketches: DataFrame, keys: Sequence[str] = ("lang", "source"), least: int = LEAST, reach: int = REACH) -> DataFrame:
    """One row per group and size with a lower and an upper fence for each ratio, in thousandths."""
    own = quartiles(sketches, keys)
    coarse = quartiles(merge(sketches, keys[:1]), keys[:1])
    world = quartiles(merge(sketches, ()), ())

    def named(frame, mark):
        return frame.select(*[F.col(c).alias(f"{mark}_{c}") for c in frame.columns])

    def same(mark, *names):
        return reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{mark}_{n}")) for n in names])

    # merged sketches: one row for each language, size and ratio, and one for each size and ratio
    rows = own.join(named(coarse, "l"), same("l", keys[0], SIZE, "ratio")).join(
        F.broadcast(named(world, "w")), same("w", SIZE, "ratio")
    )
    marks = ("", "l_", "w_")

    def chosen(value, fits):
        return F.coalesce(*[F.when(fits(m), F.col(m + value)) for m in marks])

    def many(m):
        return F.col(f"{m}total") >= least

    rows = rows.select(
        *keys, SIZE, "ratio", chosen("q25", many).alias("q25"), chosen("q75", many).alias("q75"),
        (F.coalesce(chosen("spread", lambda m: many(m) & (F.col(f"{m}spread") > 0)), F.lit(0)) * reach).alias("far"),
    )
    out = []
    for name, (_, _, lower) in RATIOS.items():
        mine = F.col("ratio") == name
        out.append(F.max(F.when(mine, F.col("q75") + F.col("far"))).alias(f"{name}_high"))
        if lower:
            out.append(F.max(F.when(mine, F.col("q25") - F.col("far"))).alias(f"{name}_low"))
    return rows.groupBy(*keys, SIZE).agg(*out)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def apply_rules(
    measured: DataFrame, limits: DataFrame, keys: Sequence[str] = ("lang", "source"), reach: int = REACH
) -> DataFrame:
    """``measured`` with base_failed and kept. Counts are compared, not ratios: ``reach`` occurrences are noise."""
    names = [c for c in limits.columns if c not in (*keys, SIZE)]
    right = limits.select(
        *[F.col(k).alias(f"_q_{k}") for k in keys], F.col(SIZE).alias("_q_of"), *[F.col(n).alias(f"_q_{n}") for n in names]
    )
    n = limits.count()
    right = F.broadcast(right) if n * 256 <= BROADCAST_BYTES else right
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys]) & (text_size() == F.col("_q_of"))
    within = [F.lit(True)]
    for name, (above, below, lower) in RATIOS.items():
        high = F.expr(f"{above} * 1000 <= _q_{name}_high * greatest({below}, 1) + {reach * 1000}")
        within.append(F.coalesce(high, F.lit(True)))
        if lower:
            low = F.expr(f"{above} * 1000 >= _q_{name}_low * greatest({below}, 1) - {reach * 1000}")
            within.append(F.coalesce(low, F.lit(True)))
    judged = measured.join(right, same, "left").withColumn("base_failed", base_failed())
    judged = judged.withColumn("kept", ~F.col("base_failed") & reduce(Column.__and__, within))
    return judged.drop("_q_of", *[f"_q_{c}" for c in (*keys, *names)])


def judge(docs: DataFrame, text_col: str = "text", keys: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Measures, base_failed and kept for every row of ``docs``; the text is left out."""
    measured = materialize(add_measures(docs, text_col), "quality-measures")
    limits = materialize(thresholds(materialize(sketch(measured, keys), "quality-sketches"), keys), "quality-limits")
    return apply_rules(measured, limits, keys)


def keep_good(docs: DataFrame, text_col: str = "text", keys: Sequence[str] = ("lang", "source")) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Texts are measured twice and never moved."""
    measured = materialize(add_measures(docs.select(text_col, *keys), text_col), "quality-measures")
    limits = materialize(thresholds(materialize(sketch(measured, keys), "quality-sketches"), keys), "quality-limits")
    clash = [c for c in docs.columns if c in (*MEASURES, "base_failed", "kept") or c.startswith("_q_")]
    inner = docs.withColumnsRenamed({c: f"_d_{c}" for c in clash})
    judged = apply_rules(add_measures(inner, text_col, keep_text=True), limits, keys)
    return judged.where("kept").select(*[F.col(f"`{c}`") for c in inner.columns]).toDF(*docs.columns)
