"""The four stages end to end: preprocess, cluster, describe, search."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import corpus, features, meaning, search, subspace, topics
from docloom.operators.language import LanguageModel, detect_language
from docloom.runtime import materialize


def paper_table(papers: DataFrame, metadata: DataFrame) -> DataFrame:
    """Papers joined to their metadata, with display and count columns, complete and unique."""
    body, abstract = F.col("body_text"), F.col("abstract")
    table = corpus.join_metadata(papers, metadata).select(
        "paper_id",
        "doi",
        "abstract",
        "body_text",
        tx.format_authors(F.col("authors")).alias("authors"),
        tx.format_title(F.col("title")).alias("title"),
        "journal",
        tx.abstract_summary(abstract).alias("abstract_summary"),
        tx.word_count(abstract).alias("abstract_word_count"),
        tx.word_count(body).alias("body_word_count"),
        tx.unique_words(body).alias("body_unique_words"),
    )
    return corpus.drop_incomplete(corpus.dedupe(table, ["abstract", "body_text"], "paper_id"))


def label_language(table: DataFrame, model: LanguageModel, language: str = "en") -> DataFrame:
    """Add ``language`` and keep one of them."""
    keyed = table.select(F.col("paper_id").alias("doc_id"), "body_text", "abstract_summary")
    labels = detect_language(keyed, model).select(F.col("doc_id").alias("paper_id"), "language")
    return corpus.filter_language(table.join(labels, "paper_id"), language)


def token_table(df: DataFrame, text: Column | str, words: list[str]) -> DataFrame:
    """Add ``vector`` (tokens) and ``vector_no_stopw`` (without stop words). Map-only."""
    source = F.col(text) if isinstance(text, str) else text
    tokens = tx.tokenize(tx.clean_text(source))
    return df.withColumn("vector", tokens).withColumn(
        "vector_no_stopw", tx.remove_stop_words(F.col("vector"), words)
    )


def text_vectors(
    df: DataFrame, k: int = 1325, max_terms: int = 4096, id_col: str = "doc_id", column: str = "text"
) -> tuple[DataFrame, subspace.Components]:
    """From texts to reduced vectors (id, vec): TF-IDF over the most frequent terms, then ``k`` principal components.

    ``k`` is at most the size of the vocabulary.
    """
    weighted = materialize(features.tfidf_l2_vectors(df, max_terms, id_col, column), "tfidf")
    width = weighted.select(F.unwrap_udt("features")["size"].alias("n")).first()["n"]
    found = subspace.fit(weighted, min(k, width))
    return subspace.project(weighted, found, id_col), found


@dataclass
class TopicModel:
    """Topics of a clustering with the (doc_id, tokens, cluster_id) rows they rest on.

    ``known`` are the clusters, ``top`` and ``taggings`` their ``m`` best terms, found on first use.
    """

    tokens: DataFrame
    topics: DataFrame
    known: DataFrame
    vocab: DataFrame
    documents: int
    m: int

    @cached_property
    def top(self) -> DataFrame:
        return materialize(topics.top_terms(self.topics, self.m, self.known, self.vocab), "top-terms")

    @property
    def taggings(self) -> DataFrame:
        return topics.taggings(self.top)


def describe_clusters(
    tokens: DataFrame, clusters: DataFrame, m: int, max_terms: int = 5000, min_df: int = 5
) -> TopicModel:
    """(doc_id, tokens) and (doc_id, cluster_id) to topics and the ``m`` best tags per cluster.

    The tokens are computed and written once, rows without any included: their clusters are known too.
    """
    cleaned = tokens.select("doc_id", tx.drop_empty(tx.drop_numeric(F.col("tokens"))).alias("tokens"))
    stored = materialize(topics.attach_clusters(cleaned, clusters), "tokens")
    attached = stored.where(F.size("tokens") > 0)
    documents = attached.count()
    vocab = features.build_vocab(features.term_stats(attached), max_terms, min_df)
    table = materialize(topics.cluster_topics(attached, vocab, documents, max_terms), "topics")
    return TopicModel(attached, table, stored.select("cluster_id").distinct(), vocab, documents, m)


def search_text(query: str, tags: DataFrame, n: int = 5, dim: int = 64) -> DataFrame:
    """(cluster_id, score) for a text query over (tag, cluster_id, line, position)."""
    embedded = search.dedupe_tags(tags).withColumn("vec", features.embed_text(F.col("tag"), dim))
    return search.search(features.embed_text(F.lit(query), dim), embedded, n)


def search_meaning(query: str, tags: DataFrame, terms: DataFrame, max_terms: int, n: int = 5, dim: int = 64) -> DataFrame:
    """(cluster_id, score) for a query by the company its words keep: (tag, ...) and the term vectors of ``meaning.fit``.

    A query without a known word falls back to ``search_text``; tags without one are not found.
    """
    asked = tags.sparkSession.range(1).select(F.col("id").alias("doc_id"), tx.tokenize(tx.clean_text(F.lit(query))).alias("tokens"))
    vector = meaning.embed_tokens(asked, terms, max_terms).first()
    if vector is None:
        return search_text(query, tags, n, dim)
    owners = search.dedupe_tags(tags)
    spelt = owners.select("tag", tx.tokenize(tx.clean_text(F.col("tag"))).alias("tokens"))
    embedded = owners.join(meaning.embed_tokens(spelt, terms, max_terms, "tag"), "tag")
    return search.search(F.lit([float(x) for x in vector["vec"]]), embedded, n)
