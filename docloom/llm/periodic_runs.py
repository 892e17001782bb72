"""Periodic runs of words: Kruskal over suffix classes by descending LCP.

A run is a stretch of consecutive words with smallest period q and at least ``max(6, 4 * q)``
words that no neighbouring word extends. Such a run starts with two equal windows of five words or
more, so a text without a repeated window has none; one counting pass settles that.

The others get a suffix order (prefix doubling) and the common prefix length (LCP) of neighbours
in it. The LCPs are the edges of a path over the suffixes. They are taken from the longest down,
and each unites the classes of its two suffixes (union-find). A class carries its positions in text order. When two classes
meet at LCP l, two positions i < j that become neighbours share exactly l words. With p = j - i <= l
the stretch from i to j + l has period p. No smaller period fits: it would have put a closer position into the
class of i at a longer LCP. The stretch ends with the LCP; where the words
before i and j differ as well, it is a whole run, and every run is met this way exactly once, from its
first position. Edges below five are not needed.

The smaller class goes into the larger one, so a text of n words takes O(n log n) insertions. Memory
is linear in one text; nothing is shuffled.

Edge cases: a null or empty text, or one of white space only, has no words and no runs; a null id is
not varied by ``vary``; repeated ids and equal texts are rows of their own; an empty table gives an
empty result; the named columns are read and any others are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import texts_of

LEAST_WORDS = 6
LEAST_TURNS = 4
# a run of q * turns words or more starts with equal windows of at least this many words
LEAST_LCP = min(max(LEAST_WORDS, LEAST_TURNS * q) - q for q in (1, 2))
FEW = 8

SCHEMA = (
    "doc_id {}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def vary(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's change: one document in ten repeats a stretch of itself to its end."""
    if doc_id is None or not words:
        return words
    h, n = crc32(b"%d" % doc_id), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((n - a) // p + 1))[: n - a]


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, by first occurrence."""
    seen: defaultdict[bytes, int] = defaultdict()
    seen.default_factory = seen.__len__
    return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense rank of each key."""
    order = np.argsort(keys, kind="stable")
    steps = np.diff(keys[order]) != 0
    out = np.empty(len(keys), np.int64)
    out[order] = np.r_[0, np.cumsum(steps)]
    return out


def repeats(ids: np.ndarray, width: int) -> bool:
    """Is some window of ``width`` words there twice?"""
    n = len(ids) - width + 1
    if n < 2:
        return False
    window = ids[:n]
    for k in range(1, width):
        window = ranks(window) * len(ids) + ids[k : k + n]
    window = np.sort(window)
    return bool((window[1:] == window[:-1]).any())


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling."""
    n = len(ids)
    rank, width = ranks(ids), 1
    while rank.max() + 1 < n:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        rank = ranks(rank * (n + 1) + after)
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def common_prefixes(ids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LCP of each suffix in ``order`` with the one before it; 0 for the first (Kasai et al. 2001)."""
    n = len(ids)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    text, before_list, out, length = ids.tolist(), before.tolist(), [0] * n, 0
    for i, j in enumerate(before_list):
        if j < 0:
            length = 0
            continue
        most = n - max(i, j)
        while length < most and text[i + length] == text[j + length]:
            length += 1
        out[i] = length
        if length:
            length -= 1
    return np.array(out, np.int64)[order]


def met(small: list[int], large: list[int]) -> list[tuple[int, int]]:
    """Neighbours (i < j) in the merged order that come from different lists."""
    places = [bisect_left(large, x) for x in small]
    found, last = [], len(small) - 1
    for k, (x, place) in enumerate(zip(small, places)):
        if place and (not k or places[k - 1] < place):
            found.append((large[place - 1], x))
        if place < len(large) and (k == last or places[k + 1] > place):
            found.append((x, large[place]))
    return found


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a text as (start, length, period), by start and then period."""
    if not repeats(ids, LEAST_LCP):
        return []
    order = suffix_order(ids)
    lcp = common_prefixes(ids, order)
    edges = np.flatnonzero(lcp >= LEAST_LCP)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    text, parent, positions, runs = ids.tolist(), {}, {}, []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for length, left, right in zip(lcp[edges].tolist(), order[edges - 1].tolist(), order[edges].tolist()):
        for x in (left, right):
            if x not in parent:
                parent[x], positions[x] = x, [x]
        a, b = find(left), find(right)
        if len(positions[a]) < len(positions[b]):
            a, b = b, a
        large, small = positions[a], positions.pop(b)
        parent[b] = a
        for i, j in met(small, large):
            period = j - i
            long_enough = period + length >= max(LEAST_WORDS, LEAST_TURNS * period)
            if long_enough and (not i or text[i - 1] != text[j - 1]):
                runs.append((i, period + length, period))
        if len(small) <= FEW:
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    start, length, period = np.array(runs).T
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def _row(words: list[bytes]) -> tuple:
    runs = find_runs(numbers(words)) if len(words) >= LEAST_WORDS else []
    longest = (None, None, None, None)
    if runs:
        start, length, period = max(runs, key=lambda run: (run[1], -run[0], -run[2]))
        longest = (start, length, period, 1000 * length // period)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    return len(words), len(runs), *longest, sha256(listed).hexdigest(), sha256(b" ".join(collapse(words, runs))).hexdigest()


def describe_runs(docs: DataFrame, varied: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: number of runs, the longest one, digests of all runs and of the collapsed text. Map-only.

    ``varied`` puts the change of ``vary`` in first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = text.split()
                rows.append(_row(vary(words, doc_id) if varied else words))
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.string()] * 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = SCHEMA.format(kind)
    names = [part.split()[0] for part in schema.split(", ")]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each text that has runs reduced to its kept words, joined by one space; other texts as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            texts = []
            for value, text in zip(column, texts_of(column)):
                words = text.split()
                runs = find_runs(numbers(words)) if len(words) >= LEAST_WORDS else []
                texts.append(b" ".join(collapse(words, runs)).decode() if runs else value.as_py())
            arrays = [pa.array(texts, column.type) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
