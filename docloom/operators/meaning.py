"""Vectors of terms by the company they keep, and of texts by their terms.

Pairs of vocabulary terms within a window are counted inside the task that reads the text, so what is shuffled
are partial counts of pairs: a task holds a few million of them at most and hands them on when there are more. Positive
pointwise mutual information, less a shift, makes them a sparse symmetric matrix with a row per term; its
principal components (``subspace``) are the vectors. A text is the mean of the vectors of its terms with smooth
inverse frequency weights SMOOTH / (SMOOTH + share of the term).

Terms outside the vocabulary stand between others but form no pairs. Null and empty token lists count for nothing,
null tokens like terms outside; a text without a known term has no vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import subspace
from docloom.runtime import BROADCAST_BYTES, broadcast_bounded, materialize

WINDOW = 5
SMOOTH = 1e-3
PIECE = 1 << 18
KEYS = 1 << 22
ROWS_OUT = 1 << 16


def cooccurrences(df: DataFrame, vocab: DataFrame, max_terms: int, window: int = WINDOW, column: str = "tokens") -> DataFrame:
    """(a, b, n): how often two vocabulary ids stand within ``window`` places, in both orders.

    A term next to itself counts twice, once for each order.
    """
    if max_terms * 64 > BROADCAST_BYTES:
        raise ValueError(f"a vocabulary of {max_terms} terms is too large to be sent to the tasks")
    terms = vocab.select("term", "term_id").collect()  # at most max_terms rows
    shared = df.sparkSession.sparkContext.broadcast({r["term"]: r["term_id"] for r in terms})
    width = max(shared.value.values(), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        found, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        waiting, held = [], 0
        for batch in batches:
            tokens = batch.column(0)
            flat = tokens.flatten().dictionary_encode()  # each different token of a batch once
            places = np.array([known.get(t, -1) for t in flat.dictionary.to_pylist()] + [-1], np.int64)
            ids = places[flat.indices.fill_null(len(places) - 1).to_numpy(zero_copy_only=False)]
            texts = np.repeat(np.arange(batch.num_rows), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            for low in range(0, len(ids), PIECE):
                high = min(low + PIECE, len(ids))
                for apart in range(1, window + 1):
                    last = min(high, len(ids) - apart)
                    if last <= low:
                        break
                    a, b = ids[low:last], ids[low + apart : last + apart]
                    both = (a >= 0) & (b >= 0) & (texts[low:last] == texts[low + apart : last + apart])
                    a, b = a[both], b[both]
                    waiting.append(np.minimum(a, b) * width + np.maximum(a, b))
                    held += len(a)
                # sorted again only when as much has come in as is counted already, so a key is sorted a few times in all
                if held > max(len(found), KEYS):
                    found, counts = _summed(found, counts, waiting)
                    waiting, held = [], 0
                    if len(found) > KEYS:
                        yield from _rows(found, counts)
                        found, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        yield from _rows(*_summed(found, counts, waiting))

    def _summed(found: np.ndarray, counts: np.ndarray, waiting: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.sort(np.concatenate([np.empty(0, np.int64), *waiting]))
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        keys, n = np.concatenate([found, keys[starts]]), np.concatenate([counts, np.diff(np.r_[starts, len(keys)])])
        order = np.argsort(keys, kind="stable")  # two sorted halves: a merge
        keys, n = keys[order], n[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        return keys[starts], np.add.reduceat(n, starts) if len(starts) else n

    def _rows(found: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(found), ROWS_OUT):
            keys, n = found[low : low + ROWS_OUT], counts[low : low + ROWS_OUT]
            yield pa.RecordBatch.from_arrays([pa.array(keys // width), pa.array(keys % width), pa.array(n)], names=["a", "b", "n"])

    half = df.select(column).mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    twin = F.array(F.struct("a", "b", "n"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    once = F.array(F.struct("a", "b", (F.col("n") * 2).alias("n")))
    return half.select(F.inline(F.when(F.col("a") == F.col("b"), once).otherwise(twin)))


def ppmi(pairs: DataFrame, max_terms: int, shift: float = 1.0) -> DataFrame:
    """(a, b, n, ppmi): ln(n N / (n_a n_b)) - ln(shift) where that is positive. ``pairs`` is read three times."""
    sums = pairs.groupBy("a").agg(F.sum("n").alias("n_a"))
    total = float(pairs.agg(F.sum("n")).first()[0] or 0)
    rows = broadcast_bounded(sums, max_terms)
    columns = broadcast_bounded(sums.select(F.col("a").alias("b"), F.col("n_a").alias("n_b")), max_terms)
    ratio = F.col("n") * F.lit(total) / F.col("n_a") / F.col("n_b") / F.lit(float(shift))
    joined = pairs.join(rows, "a").join(columns, "b")
    return joined.select("a", "b", "n", F.log(ratio).alias("ppmi")).where("ppmi > 0")


def fit(
    df: DataFrame, vocab: DataFrame, max_terms: int, k: int = 64, window: int = WINDOW, shift: float = 1.0, column: str = "tokens"
) -> DataFrame:
    """(term, vec, weight) for every vocabulary term that has a positive association; ``k`` numbers at most."""
    found = materialize(ppmi(materialize(cooccurrences(df, vocab, max_terms, window, column), "pairs"), max_terms, shift), "ppmi")
    # a row per term, with at most max_terms cells
    rows = found.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("b", "ppmi"))).alias("cells"))
    sparse = F.udf(lambda cells: SparseVector(max_terms, [c[0] for c in cells], [c[1] for c in cells]), VectorUDT())
    matrix = materialize(rows.select("a", sparse("cells").alias("features")), "ppmi-rows")
    components = subspace.fit(matrix, min(k, max_terms))
    vectors = subspace.project(matrix, components, "a")
    every = float(vocab.agg(F.sum("tf")).first()[0] or 1)
    share = vocab.select(
        "term", F.col("term_id").cast("long").alias("a"), (SMOOTH / (SMOOTH + F.col("tf") / every)).alias("weight")
    )
    return materialize(broadcast_bounded(share, max_terms).join(vectors, "a").select("term", "vec", "weight"), "term-vectors")


def embed_tokens(df: DataFrame, terms: DataFrame, max_terms: int, id_col: str = "doc_id", column: str = "tokens") -> DataFrame:
    """(id, vec): weighted mean of the vectors of a text's terms; texts without a known term are left out."""
    size = terms.agg(F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("d")).first()["d"]
    known = broadcast_bounded(terms, max_terms, 64 + 8 * size)
    words = df.select(id_col, F.explode(column).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("_n"))
    mean = Summarizer.mean(array_to_vector("vec"), F.col("weight") * F.col("_n"))
    return words.join(known, "term").groupBy(id_col).agg(mean.alias("_m")).select(id_col, vector_to_array("_m").alias("vec"))
