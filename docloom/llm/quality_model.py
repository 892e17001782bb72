"""Quality classifier: supervised subword embeddings.

A word is the mean of learned vectors of its hashed self and of its hashed character n-grams; a
text is the mean of its words and of its word pairs (of which only "the same word again" and
"another word" are told apart), with ``PRIOR`` zero vectors mixed in so that a few words alone
decide little; a softmax layer gives the classes. Vectors and layer are trained
by stochastic gradient descent (AdaGrad steps) in NumPy on the driver, on at most ``SAMPLE`` labelled texts
chosen by the hash of their ids: the one bounded sample. Every text is then scored whole.

In prediction the layer folds into the vectors, so a bucket is one number and a word one
look-up; the model that travels to the tasks has a fixed size (4 bytes x ``BUCKETS``).

Edge cases: an empty or null text gets the score of the bias alone; null labels and
labels without a text are left out; without labels of both classes every score is the smoothed
share of class 1; of a repeated id the smallest text is learned from, and repeated rows are scored alike; columns of the input are carried through except
``score``, which is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import Stored, texts_of

SAMPLE = 2000
BUCKETS = 1 << 17
LENGTHS = (3, 4, 5)
DIM = 8
EPOCHS = 4
RATE = 0.2
TINY = np.float32(1e-12)
PRIOR = 32


def buckets_of(word: bytes, buckets: int = BUCKETS) -> list[int]:
    """The hashed word and its hashed character n-grams; the last two buckets are for word pairs."""
    marked = b"<" + word + b">"
    grams = [marked] + [marked[i : i + n] for n in LENGTHS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g) % (buckets - 2) for g in grams]


@dataclass
class Model:
    """One number per bucket (the folded vectors), and the bias."""

    weights: np.ndarray
    bias: float

    def scorer(self):
        """Text bytes to a score between 0 and 1."""
        weights, buckets = self.weights.astype(float).tolist(), len(self.weights)

        def word_value(word):
            found = buckets_of(word, buckets)
            return sum([weights[b] for b in found]) / len(found)

        again, other, values = weights[-2], weights[-1], Stored(word_value)

        def score(text: bytes) -> float:
            words = text.split()
            logit = self.bias
            if words:
                n, repeats = len(words), sum(map(operator.eq, words, words[1:]))
                total = sum(map(values.__getitem__, words)) + repeats * again + (n - 1 - repeats) * other
                logit += total / (2 * n - 1 + PRIOR)
            return 1 / (1 + math.exp(-max(-60.0, min(60.0, logit))))

        return score


def _features(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares in its mean."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    places, shares = [], []
    for word, n in Counter(words).items():
        found = buckets_of(word, buckets)
        places += found
        shares += [n / len(found)] * len(found)
    repeats = sum(map(operator.eq, words, words[1:]))
    places += [buckets - 2, buckets - 1]
    shares += [repeats, len(words) - 1 - repeats]
    distinct, back = np.unique(places, return_inverse=True)
    return distinct.astype(np.int32), (np.bincount(back, shares) / (2 * len(words) - 1 + PRIOR)).astype(np.float32)


def train(texts: list[bytes], labels: list[int], seed: int = 7, buckets: int = BUCKETS) -> Model:
    """Fit by SGD, one text at a time, with a rate that falls to zero."""
    ones = sum(labels)
    if not ones or ones == len(labels):
        return Model(np.zeros(buckets, np.float32), math.log((ones + 1) / (len(labels) - ones + 1)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (buckets, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    # the log-odds of the classes, held: that is what a text without words gets
    bias = np.array([0, math.log(ones / (len(labels) - ones))], np.float32)
    spent = np.zeros(buckets, np.float32)
    grown = np.zeros_like(layer)
    rows = [_features(t, buckets) for t in texts]
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            places, shares = rows[i]
            if not len(places):
                continue
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            own = vectors[places]
            mean = shares @ own
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[i]] -= 1
            back = layer @ error
            # AdaGrad: shares are tiny and uneven, so every bucket keeps a step size of its own
            force = shares * np.float32(math.sqrt(back @ back))
            spent[places] += force * force
            vectors[places] = own - np.outer(shares * (rate / np.sqrt(spent[places] + TINY)), back)
            grown += np.outer(mean, error) ** 2
            layer -= rate * np.outer(mean, error) / np.sqrt(grown + TINY)
    fold = layer[:, 1] - layer[:, 0]
    return Model(vectors @ fold, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on (doc_id, text) with (doc_id, label): at most ``sample`` labelled rows, by hash of the id."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IN (0, 1)")
        .select("doc_id", "label")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    # at most ``sample`` rows of two numbers; copies of an id meet in one aggregate, so no more texts than that are collected
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    rows = found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    rows = sorted((r["doc_id"], r["label"], r["text"].encode()) for r in rows)
    return train([r[2] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``. Map-only; only the text is sent to Python, and only the score comes back."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = Model(*shared.value).scorer()
        for column in texts:
            yield pa.array([one(t) for t in texts_of(column)], pa.float64())

    # not deterministic for the planner: else a filter on the score would have every text scored twice
    found = F.arrow_udf(run, "double").asNondeterministic()(F.col(f"`{text_col}`"))
    return docs.select(*kept, found.alias("score"))
