"""Spelling variants: words one edit apart, by dynamic programming over sorted lists.

Words are counted per task and then by one aggregation. For the search, a word is cut into ``PARTS`` parts
by its length m: an edit falls into one part and leaves the text before and after it as it is.
So words that are near share all but one part, and every list of words that do is searched by
itself. A word enters the lists of its own length and, for partners one shorter, those of m - 1.

A list is sorted by the part that differs. For each word the following ones are scanned with the rows of
the edit matrix, of which three cells a row can be one edit or less. The rows of the prefix that a word shares with
the one before it (their LCP) are used again, and where a row has no cell of one or less the scan jumps past all
words with that prefix.

A list with more than ``BLOCK`` words is cut into blocks by a hash, and each pair of blocks is a
list of its own, so no task holds more than two blocks whatever the key. A pair is reported by the first
part that can hold its edit, from the pair of blocks that it belongs to: once.

A form has at least five times the count of its word, so chains of forms are short and have no cycles;
roots come from pointer doubling with joins.

Edge cases: null and empty texts have no words; a null id counts as empty text in what ``slip`` sees;
repeated ids and equal texts are counted each; words of any length are compared whole; an empty table
gives an empty result; the named columns are read and any others are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import LOWER, texts_of
from docloom.runtime import BROADCAST_BYTES, forget, materialize

LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_TIMES = 5
PARTS = 3
BLOCK = 8192
MAX_COUNTED = 300_000
ROWS_PER_TASK = 40_000
SLIP = 199
KEY = ("m", "part", "head", "tail", "b1", "b2")
# maximal runs of the contract in text whose A-Z are lower-cased, if they are long enough
RUNS = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)


def slip(prefix: int, word: str) -> str:
    """The contract's change: one (document, word) in ``SLIP`` loses a character."""
    h = crc32(word.encode(), prefix)
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, slips: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words with ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found = Counter(RUNS.findall(text.translate(LOWER).decode()))
                if not slips:
                    total.update(found)
                else:
                    prefix = crc32(("" if doc_id is None else f"{doc_id}").encode() + b":")
                    for word, n in found.items():
                        word = slip(prefix, word)
                        if len(word) >= LEAST_LENGTH:
                            total[word] += n
                if len(total) > MAX_COUNTED:
                    yield counted()
                    total.clear()
        if total:
            yield counted()

    rows = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def cuts(m: int) -> list[int]:
    """Bounds of the parts of a word of ``m`` code points."""
    return [m * k // PARTS for k in range(PARTS + 1)]


def lists_of(words: DataFrame) -> DataFrame:
    """Rows (m, part, head, tail, middle, n): each word in the lists of its length and of one less."""
    options = []
    length, word = F.length("word"), F.col("word")
    for less in (0, 1):
        m = length - less
        for part in range(PARTS):
            begin = F.floor(m * part / PARTS).cast("int")
            end = F.floor(m * (part + 1) / PARTS).cast("int")
            options.append(
                F.when(
                    m >= LEAST_LENGTH,
                    F.struct(
                        m.alias("m"), F.lit(part).alias("part"), F.substr(word, F.lit(1), begin).alias("head"),
                        F.substr(word, length - (m - end) + 1, m - end).alias("tail"),
                        F.substr(word, begin + 1, length - begin - (m - end)).alias("middle"),
                    ),
                )
            )
    return words.select("n", F.explode(F.array_compact(F.array(*options))).alias("row")).select("row.*", "n")


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def scan(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs (i < j) of a sorted list of different words that are one edit apart."""
    n = len(words)
    lcp = [0] + [shared(words[i - 1], words[i]) for i in range(1, n)]
    for q in range(n - 1):
        a = words[q]
        size = len(a)
        # rows[t]: edits between the first t letters of the scanned word and t - 1, t, t + 1 letters of a; 2 is "more"
        rows = [(1 if t else 2, 0, 1 if t < size else 2) for t in range(size + 1)]
        valid, i = size, q + 1
        while i < n:
            b = words[i]
            t = valid = min(valid, lcp[i])
            end = len(b)
            x, y, z = rows[t]
            while t < end and (x < 2 or y < 2 or z < 2):
                c = b[t]
                t += 1
                x = min(x + (t < 2 or t - 2 >= size or c != a[t - 2]), y + 1, 2) if t - 1 <= size else 2
                y = min(y + (c != a[t - 1]), z + 1, x + 1, 2) if t <= size else 2
                z = min(z + (c != a[t]), y + 1, 2) if t < size else 2
                if t == len(rows):
                    rows.append((x, y, z))
                else:
                    rows[t] = (x, y, z)
            i += 1
            if x < 2 or y < 2 or z < 2:
                if abs(size - end) < 2 and (y, z, x)[size - end] == 1:
                    yield q, i - 1
                valid = end
            else:
                while i < n and lcp[i] >= t:
                    i += 1
                valid = t - 1


def first_part(u: str, v: str, m: int) -> int:
    """The first part of the shorter length that holds the only edit between two near words."""
    bounds = cuts(m)
    head = shared(u, v)
    tail = shared(u[::-1], v[::-1])
    return next(p for p in range(PARTS) if head >= bounds[p] and tail >= m - bounds[p + 1])


def near_in_list(key: tuple, rows: Iterable[tuple]) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, near word, its n) for each pair that this list reports; ``rows`` are (middle, n, block) by middle."""
    rows = list(rows)
    if len(rows) < 2:
        return
    m, part, head, tail, b1, b2 = key
    bounds = cuts(m)
    width = bounds[part + 1] - bounds[part]
    for i, j in scan([r[0] for r in rows]):
        (one, n, block), (two, k, other) = rows[i], rows[j]
        if min(len(one), len(two)) > width or (min(block, other), max(block, other)) != (b1, b2):
            continue  # a list of longer words, or another pair of blocks, reports it
        u, v = head + one + tail, head + two + tail
        if first_part(u, v, m) == part:
            yield u, n, v, k


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of words one edit apart. ``words`` is written and read again."""
    lists = lists_of(words)
    key = [F.col(c) for c in KEY[:4]]
    large = materialize(lists.groupBy(*key).count().where(F.col("count") > BLOCK), "spelling-large")
    n_large = large.count()
    total = words.count() * 2 * PARTS
    if n_large:
        held = F.broadcast(large) if n_large * 256 <= BROADCAST_BYTES else large
        lists = lists.join(held, list(KEY[:4]), "left").withColumn("blocks", F.ceil(F.coalesce("count", F.lit(1)) / BLOCK).cast("int"))
        lists = lists.withColumn("block", F.pmod(F.xxhash64("middle"), F.col("blocks")).cast("int"))
        lists = lists.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        lists = lists.withColumns({"b1": F.least("block", "other"), "b2": F.greatest("block", "other")})
    else:
        lists = lists.withColumns({c: F.lit(0) for c in ("block", "b1", "b2")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                yield from zip(zip(*columns[:6]), zip(*columns[6:]))

        found: list[tuple] = []

        def pairs() -> pa.RecordBatch:
            both = [(u, v, k) for u, n, v, k in found] + [(v, u, n) for u, n, v, k in found]
            columns = list(zip(*both))
            arrays = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "near", "near_n"])

        for key, group in groupby(rows(), itemgetter(0)):
            found.extend(near_in_list(key, (row for _, row in group)))
            if len(found) > 10_000:
                yield pairs()
                found.clear()
        if found:
            yield pairs()

    dealt = lists.select(*KEY, "middle", "n", "block").repartition(-(-total // ROWS_PER_TASK) or 1, *KEY)
    return dealt.sortWithinPartitions(*KEY, "middle").mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form)."""
    current = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if current.join(further, "root").isEmpty():
            return current
        moved = current.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        before, current = current, materialize(moved, "spelling-roots")
        forget(before)


def group_variants(
    docs: DataFrame, slips: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n, n_near, form, form_n, root): ``form`` is the most frequent near word, ties by code points, if it
    has ``FORM_TIMES`` times the count; ``root`` ends the chain of forms."""
    words = materialize(count_words(docs, slips, id_col, text_col), "spelling-words")
    near = near_words(words)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    )
    often = -F.col("best.minus") >= FORM_TIMES * F.col("n")
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.minus")).alias("form_n"),
    )
    facts = materialize(joined, "spelling-facts")
    ends = roots(facts.where("form IS NOT NULL"))
    return facts.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
