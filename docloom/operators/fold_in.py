"""Topic distributions of documents for given topics, and the documents that a topic weighs most.

A document's distribution over fixed topics is folded in by expectation-maximisation on its own words:
a step shares every word among the topics by weight times probability and adds the shares up. Documents are
independent, so this is a map; the topics (numbers of topics x terms) are broadcast and bounded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.operators.corpus import first_in_group
from docloom.runtime import MODEL_BYTES


def smoothed_topics(df: DataFrame, terms: Sequence[str], column: str = "tokens") -> tuple[list[int], np.ndarray]:
    """(cluster ids, probabilities): a topic per cluster of (doc_id, tokens, cluster_id), add-one over ``terms``.

    Only (cluster, term) counts leave the tasks.
    """
    place = {t: i for i, t in enumerate(terms)}
    words = F.broadcast(df.sparkSession.createDataFrame([(t,) for t in terms], "term string"))
    counts = df.select("cluster_id", F.explode(column).alias("term")).join(words, "term").groupBy("cluster_id", "term").agg(F.count("*").alias("tf"))
    ids = [r["cluster_id"] for r in df.select("cluster_id").distinct().orderBy("cluster_id").collect()]
    _check(len(ids), len(terms))
    row, found = {c: i for i, c in enumerate(ids)}, np.ones((len(ids), len(terms)))
    for r in counts.collect():  # at most clusters x terms
        found[row[r["cluster_id"]], place[r["term"]]] += r["tf"]
    return ids, found / found.sum(axis=1, keepdims=True)


def _check(topics: int, terms: int) -> None:
    if topics * terms * 8 > MODEL_BYTES:
        raise ValueError(f"{topics} topics x {terms} terms exceed {MODEL_BYTES} bytes")


def distributions(df: DataFrame, terms: Sequence[str], topics: np.ndarray, steps: int = 20, column: str = "tokens") -> DataFrame:
    """(doc_id, topics): the distribution of each document over the rows of ``topics``. Map-only.

    Starts even and takes ``steps`` steps; a document without a known word stays even.
    """
    _check(*topics.shape)
    shared = df.sparkSession.sparkContext.broadcast(({t: i for i, t in enumerate(terms)}, topics))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, phi = shared.value
        k = len(phi)
        by_term = np.ascontiguousarray(phi.T)
        for batch in batches:
            out = np.full((batch.num_rows, k), 1 / k)
            for rows, at, counts in kernels.term_runs(batch.column(1), place, kernels.CHUNK_CELLS // k):
                owners, starts, back = np.unique(rows, return_index=True, return_inverse=True)
                p, theta = by_term[at], out[owners]
                for _ in range(steps):
                    shares = counts / np.einsum("nk,nk->n", theta[back], p)
                    theta *= np.add.reduceat(p * shares[:, None], starts, axis=0)
                    theta /= theta.sum(axis=1, keepdims=True)
                out[owners] = theta
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, k, dtype=np.int32)), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "topics"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", column).mapInArrow(run, f"doc_id {kind}, topics array<double>")


def documents_of_topics(found: DataFrame, n: int) -> DataFrame:
    """(topic, doc_id, weight, rank): the ``n`` documents with the most weight on each topic, of (doc_id, topics).

    Weights that agree to nine decimals tie and go by id. The rank is limited inside the map tasks, so no topic meets in one.
    """
    rows = found.select("doc_id", F.posexplode("topics").alias("topic", "weight"))
    ordered = rows.withColumn("_down", -F.round("weight", 9))
    return first_in_group(ordered, "topic", ["_down", "doc_id"], n).drop("_down")
