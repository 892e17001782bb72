"""Keywords of clusters and the documents that represent them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.corpus import first_in_group
from docloom.operators.features import doc_terms, with_idf
from docloom.runtime import BROADCAST_BYTES, broadcast_bounded


def attach_clusters(tokens: DataFrame, clusters: DataFrame) -> DataFrame:
    """Join assignments (doc_id, cluster_id) to documents by id."""
    return tokens.join(clusters.select("doc_id", "cluster_id"), "doc_id")


def cluster_topics(
    df: DataFrame,
    vocab: DataFrame,
    documents: int,
    max_terms: int,
    eta: float = 1.0,
    column: str = "tokens",
) -> DataFrame:
    """(cluster_id, term, weight): the one-topic LDA of every cluster at once.

    With a single topic every token belongs to it, so the topic is the smoothed sum of the
    TF-IDF weights: (eta + sum) / (V eta + cluster total), V being the size of the whole
    vocabulary. TF-IDF sums need only (cluster, term) counts, which combine map-side;
    terms that do not occur in a cluster are left out of the table, whose column ``absent``
    has the weight that each of them has.
    """
    words = broadcast_bounded(with_idf(vocab, documents).select("term", "idf"), max_terms)
    size = vocab.count()
    counts = (
        df.select("cluster_id", F.explode(column).alias("term"))
        .join(words, "term")
        .groupBy("cluster_id", "term", "idf")
        .agg(F.count("*").alias("tf"))
        .select("cluster_id", "term", (F.col("tf") * F.col("idf")).alias("_s"))
    )
    total = F.sum("_s").over(Window.partitionBy("cluster_id"))
    # a cluster's window holds at most max_terms rows
    return counts.withColumn("_all", total).select(
        "cluster_id",
        "term",
        ((F.lit(eta) + F.col("_s")) / (F.lit(size * eta) + F.col("_all"))).alias("weight"),
        (F.lit(eta) / (F.lit(size * eta) + F.col("_all"))).alias("absent"),
    )


def top_terms(topics: DataFrame, m: int, clusters: DataFrame, vocab: DataFrame) -> DataFrame:
    """(cluster_id, term, weight, rank): the ``m`` heaviest vocabulary terms per cluster, ties by term.

    Every cluster of ``clusters`` (cluster_id) gets its terms. A term that the cluster lacks can
    only come in by its name, so the first ``m`` terms of the vocabulary are all that is added.
    """
    first = [row["term"] for row in vocab.select("term").orderBy("term").limit(m).collect()]
    even = 1.0 / max(vocab.count(), 1)
    rest = (
        clusters.select("cluster_id").distinct()
        .join(topics.groupBy("cluster_id").agg(F.max("absent").alias("absent")), "cluster_id", "left")
        .select("cluster_id", F.explode(F.lit(first).cast("array<string>")).alias("term"), F.coalesce("absent", F.lit(even)).alias("weight"))
        .join(topics.select("cluster_id", "term"), ["cluster_id", "term"], "left_anti")
    )
    return first_in_group(
        topics.select("cluster_id", "term", "weight").unionByName(rest).withColumn("_down", -F.col("weight")),
        "cluster_id", ["_down", "term"], m,
    ).drop("_down")


def taggings(ranked_terms: DataFrame) -> DataFrame:
    """(cluster_id, tags, weights) from ``top_terms``: arrays by rank."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term", "weight")))
    return (
        ranked_terms
        .groupBy("cluster_id")
        .agg(ranked.alias("_t"))
        .select("cluster_id", F.col("_t.term").alias("tags"), F.col("_t.weight").alias("weights"))
    )


def tag_table(tagged: DataFrame) -> DataFrame:
    """(tag, cluster_id, line, position): one row per tag, in cluster and rank order."""
    return tagged.select(
        F.posexplode("tags").alias("position", "tag"), "cluster_id", F.col("cluster_id").alias("line")
    ).select("tag", "cluster_id", "line", "position")


def decode_terms(df: DataFrame, vocab: DataFrame, max_terms: int) -> DataFrame:
    """Replace ``term_id`` by its word."""
    words = broadcast_bounded(vocab.select("term_id", "term"), max_terms)
    return df.join(words, "term_id").drop("term_id")


def clustered_documents(documents: DataFrame, clusters: DataFrame, tagged: DataFrame) -> DataFrame:
    """Each document once, with its cluster and the cluster's tags.

    The clusters are counted: while their tags are small, documents are not moved to them.
    """
    tags = broadcast_bounded(tagged, tagged.count(), 1024)
    return attach_clusters(documents, clusters).join(tags, "cluster_id", "left")


def document_weights(
    df: DataFrame,
    topics: DataFrame,
    vocab: DataFrame,
    documents: int,
    max_terms: int,
    max_clusters: int,
    column: str = "tokens",
) -> DataFrame:
    """(doc_id, cluster_id, weight): sum of TF-IDF times topic weight over a document's terms.

    A cluster is one row with an array of weights by term number, max_terms doubles at most
    (24 MB for 610 clusters and 5000 terms). While the arrays of all clusters are small they
    are broadcast like the vocabulary; terms are then never shuffled, and one row per
    document is. Beyond that clusters and terms are joined by a shuffle.
    """
    words = with_idf(vocab, documents).select("term", "term_id", "idf")
    weighted = topics.join(broadcast_bounded(words, max_terms), "term").select(
        "cluster_id", "term", "term_id", (F.col("weight") * F.col("idf")).alias("_w")
    )
    counted = doc_terms(df, ("doc_id", "cluster_id"), column)
    if max_clusters * max_terms * 8 <= BROADCAST_BYTES:

        def dense(rows: pd.DataFrame) -> pd.DataFrame:
            weights = np.zeros(max_terms)
            weights[rows["term_id"].to_numpy()] = rows["_w"].to_numpy()
            return pd.DataFrame({"cluster_id": rows["cluster_id"].iloc[:1], "_ws": [weights]})

        kind = df.schema["cluster_id"].dataType.simpleString()
        arrays = weighted.groupBy("cluster_id").applyInPandas(dense, f"cluster_id {kind}, _ws array<double>")
        found = counted.join(F.broadcast(words.select("term", "term_id")), "term").join(F.broadcast(arrays), "cluster_id")
        found = found.withColumn("_w", F.get("_ws", F.col("term_id")))
    else:
        found = counted.join(weighted, ["cluster_id", "term"])
    return found.groupBy("doc_id", "cluster_id").agg(F.sum(F.col("tf") * F.col("_w")).alias("weight"))


def relevant_documents(weights: DataFrame, n: int, cluster_id: int | None = None) -> DataFrame:
    """The ``n`` heaviest documents of one cluster, or of every cluster.

    Weights that agree to nine decimals tie and go by id, since copies of a text may differ
    in the last bit of their sums. A hot cluster never meets in one task; see ``first_in_group``.
    """
    if cluster_id is not None:
        return (
            weights.where(F.col("cluster_id") == cluster_id)
            .orderBy(F.round("weight", 9).desc(), "doc_id")
            .limit(n)
        )
    ordered = weights.withColumn("_down", -F.round("weight", 9))
    return first_in_group(ordered, "cluster_id", ["_down", "doc_id"], n).drop("_down")
