"""Term statistics, TF-IDF, PCA and embeddings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.functions import text as tx
from docloom.runtime import broadcast_bounded, materialize


def term_counts(tokens: Column) -> Column:
    """array<struct<term, tf>> of one row's tokens, by sorting and run lengths.

    Counting inside the row leaves nothing to shuffle by (document, term).
    """

    def runs(words: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(words)),
            lambda i: (i == 1) | (F.get(words, i - 1) != F.get(words, i - 2)),
        )
        return tx.let(
            starts,
            lambda s: F.zip_with(
                s,
                F.slice(s, F.lit(2), F.size(s)),
                lambda a, b: F.struct(
                    F.get(words, a - 1).alias("term"),
                    (F.coalesce(b, F.size(words) + 1) - a).cast("long").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.when(F.size(tokens) > 0, tx.let(F.sort_array(tokens), runs)).otherwise(empty)


def doc_terms(df: DataFrame, id_cols: Sequence[str] = ("doc_id",), column: str = "tokens") -> DataFrame:
    """Long form (ids, term, tf). Map-only."""
    return df.select(*id_cols, F.explode(term_counts(F.col(column))).alias("_t")).select(
        *id_cols, "_t.term", "_t.tf"
    )


def term_stats(df: DataFrame, column: str = "tokens") -> DataFrame:
    """(term, tf, df): total count and number of documents per term, in one shuffle."""
    return (
        df.select(F.explode(term_counts(F.col(column))).alias("_t"))
        .groupBy(F.col("_t.term").alias("term"))
        .agg(F.sum("_t.tf").alias("tf"), F.count("*").alias("df"))
    )


def build_vocab(stats: DataFrame, max_terms: int = 5000, min_df: int = 5) -> DataFrame:
    """(term, term_id, tf, df): the most frequent terms, ties by term; ids from 0.

    Written out, because every later step reads it and it costs a pass over the corpus.
    """
    top = stats.where(F.col("df") >= min_df).orderBy(F.desc("tf"), "term").limit(max_terms)
    # at most max_terms rows, so one task numbers them
    ranked = Window.orderBy(F.desc("tf"), "term")
    return materialize(top.withColumn("term_id", F.row_number().over(ranked) - 1), "vocab")


def with_idf(vocab: DataFrame, documents: int) -> DataFrame:
    """Add idf = ln((documents + 1) / (df + 1))."""
    return vocab.withColumn("idf", F.log(F.lit(documents + 1.0) / (F.col("df") + 1.0)))


def count_vectorize(
    df: DataFrame,
    vocab: DataFrame,
    max_terms: int,
    id_cols: Sequence[str] = ("doc_id",),
    column: str = "tokens",
) -> DataFrame:
    """(ids, term_id, term, tf) for terms of the vocabulary."""
    words = broadcast_bounded(vocab.select("term", "term_id"), max_terms)
    return doc_terms(df, id_cols, column).join(words, "term")


def idf_weight(
    df: DataFrame,
    vocab: DataFrame,
    documents: int,
    max_terms: int,
    id_cols: Sequence[str] = ("doc_id",),
    column: str = "tokens",
) -> DataFrame:
    """(ids, term, tf, idf, weight = tf x idf)."""
    words = broadcast_bounded(with_idf(vocab, documents).select("term", "idf"), max_terms)
    return (
        doc_terms(df, id_cols, column)
        .join(words, "term")
        .withColumn("weight", F.col("tf") * F.col("idf"))
    )


def tfidf_l2(
    df: DataFrame, documents: int, max_terms: int = 4096, id_col: str = "doc_id", column: str = "text"
) -> DataFrame:
    """(id, term, weight): tf x (ln((1+n)/(1+df)) + 1) over word runs, rows of length one.

    Rows go to their id once, before they are exploded; the norm is then local to the task.
    """
    tokens = df.select(id_col, tx.word_runs(F.col(column)).alias("tokens"))
    vocab = build_vocab(term_stats(tokens), max_terms, 1)
    words = broadcast_bounded(
        vocab.select("term", (F.log(F.lit(documents + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("_idf")),
        max_terms,
    )
    weights = (
        doc_terms(tokens.repartition(id_col), (id_col,))
        .join(words, "term")
        .select(id_col, "term", (F.col("tf") * F.col("_idf")).alias("_w"))
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return weights.withColumn("weight", F.col("_w") / norm).drop("_w")


def tfidf_l2_vectors(
    df: DataFrame, max_terms: int = 4096, id_col: str = "doc_id", column: str = "text"
) -> DataFrame:
    """The same weights as ``tfidf_l2`` as sparse vectors: (id, features).

    Two small aggregations fix vocabulary and idf; the vectors themselves are map-only.
    """
    tokens = df.select(id_col, tx.word_runs(F.col(column)).alias("tokens"))
    documents = tokens.count()
    terms = build_vocab(term_stats(tokens), max_terms, 1).orderBy("term_id").collect()
    idf = [float(np.log((documents + 1.0) / (t["df"] + 1.0)) + 1.0) for t in terms]
    counter = CountVectorizerModel.from_vocabulary(
        [t["term"] for t in terms], inputCol="tokens", outputCol="_tf"
    )
    scaler = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")
    return unit.transform(scaler.transform(counter.transform(tokens))).select(id_col, "features")


def tfidf_vectors(
    df: DataFrame, max_terms: int = 5000, min_df: float = 5.0, column: str = "tokens"
) -> tuple[DataFrame, list[str]]:
    """Add sparse TF-IDF ``features`` to a token frame; returns the vocabulary as well."""
    counter = CountVectorizer(
        inputCol=column, outputCol="raw_features", vocabSize=max_terms, minDF=min_df
    ).fit(df)
    counted = counter.transform(df)
    weigher = IDF(inputCol="raw_features", outputCol="features").fit(counted)
    return weigher.transform(counted).drop("raw_features"), counter.vocabulary


def hashing_tf(df: DataFrame, num_features: int = 4096, column: str = "tokens") -> DataFrame:
    """Add hashed term frequencies ``features`` (sparse)."""
    return HashingTF(numFeatures=num_features, inputCol=column, outputCol="features").transform(df)


def hashed_tfidf(df: DataFrame, num_features: int = 4096, column: str = "tokens") -> DataFrame:
    """Hashed term frequencies weighted by inverse document frequency."""
    counted = hashing_tf(df, num_features, column).withColumnRenamed("features", "_tf")
    return IDF(inputCol="_tf", outputCol="features").fit(counted).transform(counted).drop("_tf")


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns into one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def _centred(df: DataFrame, fitted, column: str) -> DataFrame:
    """Project and shift the scores so that each component has mean zero."""
    scores = fitted.transform(df)
    mean = df.select(Summarizer.mean(F.col(column)).alias("m")).first()["m"]
    shift = fitted.pc.toArray().T @ mean.toArray()
    return scores.withColumn(
        "vec",
        F.zip_with(vector_to_array("_pc"), F.lit([float(s) for s in shift]), lambda a, b: a - b),
    ).drop("_pc")


def pca_project(df: DataFrame, k: int, column: str = "features") -> DataFrame:
    """Add ``vec``, the centred scores on the first ``k`` principal components."""
    fitted = PCA(k=k, inputCol=column, outputCol="_pc").fit(df)
    return _centred(df, fitted, column)


def pca_variance(
    df: DataFrame, share: float = 0.8, column: str = "features"
) -> tuple[DataFrame, list[float]]:
    """Keep the fewest components whose variance share exceeds ``share``.

    Fitted once at full width; returns the projected frame and the shares of all components.
    """
    width = df.select(column).first()[column].size
    fitted = PCA(k=width, inputCol=column, outputCol="_pc").fit(df)
    ratios = [float(r) for r in fitted.explainedVariance]
    reached = np.nonzero(np.cumsum(ratios) > share)[0]
    k = int(reached[0]) + 1 if len(reached) else width
    return _centred(df, fitted, column).withColumn("vec", F.slice("vec", 1, k)), ratios


def covariance(df: DataFrame) -> DataFrame:
    """(i, j, cov) of an array<double> column ``vec``; sample covariance.

    Each task sums its own products with one matrix product per Arrow batch and emits one
    row per dimension, so what is shuffled does not depend on the number of vectors.
    """

    def partial(parts):
        summed = kernels.gram(parts)
        if summed is not None:
            n, sums, products = summed
            yield pd.DataFrame(
                {"i": range(len(sums)), "n": n, "s": sums, "row": list(products)}
            )

    rows = (
        df.select("vec")
        .mapInPandas(partial, "i int, n long, s double, row array<double>")
        .groupBy("i")
        .agg(
            F.sum("n").alias("n"),
            F.sum("s").alias("s"),
            Summarizer.sum(array_to_vector("row")).alias("row"),
        )
    )
    # one row per dimension
    sums = rows.select(F.col("i").alias("j"), F.col("s").alias("sj"))
    return (
        rows.select("i", "n", "s", F.posexplode(vector_to_array("row")).alias("j", "p"))
        .join(sums, "j")
        .select("i", "j", ((F.col("p") - F.col("s") * F.col("sj") / F.col("n")) / (F.col("n") - 1)).alias("cov"))
    )


def embed_text(text: Column, dim: int = 64) -> Column:
    """Default text embedding for tags and queries: counts of hashed character trigrams.

    Meant for short strings. Anything that adds an array<double> column can take its place.
    """
    buckets = F.transform(
        tx.char_ngrams(F.lower(text), 3, 3),
        lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 8), 16, 10).cast("long") % dim,
    )
    return tx.let(
        buckets,
        lambda b: F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)),
            lambda i: F.size(F.filter(b, lambda x: x == i)).cast("double"),
        ),
    )
