"""Language labels from a character n-gram model that is fitted and applied with joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators.corpus import union_parts
from docloom.runtime import broadcast_bounded, materialize

LOW, HIGH = 1, 3


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and (gram, scores): log-probability of the gram in each of them."""

    languages: list[str]
    grams: DataFrame
    size: int


def fit_language_model(
    df: DataFrame, text: str = "text", language: str = "lang"
) -> LanguageModel:
    """Naive Bayes over all 1- to 3-grams of each language, add-one smoothed.

    Words are counted before they are cut into n-grams, so n-grams are produced once per
    distinct word, not once per occurrence.
    """
    words = (
        df.select(F.col(language).alias("lang"), F.explode(tx.space_words(F.lower(text))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("c"))
    )
    counts = materialize(
        words.select("lang", "c", F.explode(tx.char_ngrams(F.col("word"), LOW, HIGH)).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.sum("c").alias("c")),
        "grams",
    )
    totals = counts.groupBy("lang").agg(F.sum("c").alias("n")).orderBy("lang").collect()
    languages = [row["lang"] for row in totals]
    size = counts.select("gram").distinct().count()

    def score(row) -> Column:
        seen = F.coalesce(F.sum(F.when(F.col("lang") == row["lang"], F.col("c"))), F.lit(0))
        return F.log((seen + 1.0) / F.lit(float(row["n"] + size)))

    grams = counts.groupBy("gram").agg(F.array(*[score(row) for row in totals]).alias("scores"))
    return LanguageModel(languages, materialize(grams, "language-model"), size)


def _score(df: DataFrame, words: Column, model: LanguageModel) -> DataFrame:
    """(doc_id, lang, score) of the best language; null where no n-gram is known."""
    # the grams are counted: past the bound they are joined by a shuffle
    known = broadcast_bounded(model.grams, model.size, 32 + 8 * len(model.languages))
    grams = df.select("doc_id", F.explode(words).alias("word")).select(
        "doc_id", F.explode(tx.char_ngrams(F.lower("word"), LOW, HIGH)).alias("gram")
    )
    n = len(model.languages)
    sums = (
        grams.join(known, "gram")
        .groupBy("doc_id")
        .agg(F.array(*[F.sum(F.get("scores", F.lit(i))) for i in range(n)]).alias("s"))
    )
    best = F.array_max("s")
    names = F.lit(model.languages)
    return sums.select(
        "doc_id",
        F.get(names, (F.array_position("s", best) - 1).cast("int")).alias("language"),
        best.alias("score"),
    )


def detect_language(df: DataFrame, model: LanguageModel, words: int = 50) -> DataFrame:
    """(doc_id, abstract_summary, body_text) to (doc_id, language, score).

    The first ``words`` words decide; documents with no known n-gram there are tried again
    on the set of all their words, then on ``abstract_summary``, and end as ``unknown``.
    Each retry touches only the documents still open: ids are compared first, and texts
    stay where they are while the open ids are few enough to be broadcast.
    """
    split = tx.space_words(F.col("body_text"))
    stages = [
        F.slice(split, 1, words),
        F.array_distinct(split),
        tx.space_words(F.col("abstract_summary")),
    ]
    open_docs, found = df, []
    for stage in stages:
        scored = materialize(_score(open_docs, stage, model), "language")
        found.append(scored)
        ids = materialize(open_docs.select("doc_id").join(scored, "doc_id", "left_anti"), "open-ids")
        left = ids.count()
        if left == 0:
            break
        open_docs = df.join(broadcast_bounded(ids, left), "doc_id", "left_semi")
    labelled = union_parts(*found)
    return (
        df.select("doc_id")
        .join(labelled, "doc_id", "left")
        .select("doc_id", F.coalesce("language", F.lit("unknown")).alias("language"), "score")
    )
