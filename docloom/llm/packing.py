"""Best-fit packing of token sequences by patterns from non-negative least squares.

Documents become ids with an end id; only those longer than a sequence are cut. All planning is
done on the histogram of piece lengths, which has at most ``capacity`` rows whatever the
corpus. Lengths fall into bins; patterns are all ways to fill a sequence with at most
``PARTS`` bins. Non-negative least squares finds how often to repeat each pattern so that the
patterns together use up the histogram; the counts are rounded down. A repeated pattern is
realised with the longest lengths left in its bins, the last part by best fit, and what still
has room is filled by best fit as well. Pieces that no pattern used are packed by best fit,
longest first. Equal combinations are planned once with a count, so the plan is bounded by the number of
lengths and patterns, not by the corpus.

Pieces are then numbered within their length (ranges of (length, id), so a length that a third of
the pieces share is no hot group) and find their sequence and offset in the plan by number.

Edge cases: null and empty texts are one piece of the end id alone; a document of any
length is cut into full pieces and a shorter last one; rows with a null or a repeated id are packed
like any others; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.bpe import Codec, newer_characters
from docloom.operators.corpus import number_within
from docloom.runtime import broadcast_bounded, materialize

BINS = 64
PARTS = 4


class LibraryCodec(Codec):
    """Ids by the tokenizers library, one run without white space at a time."""

    def ids_of(self, symbols: list[str]) -> bytes:
        return array("I", [t.id for t in self.library.model.tokenize("".join(symbols))]).tobytes()


def cut_documents(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document. Map-only."""

    newer = newer_characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = LibraryCodec(path, newer), array("I", [end_id]).tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows, number, starts, lengths, crcs, kept = [], [], [], [], [], []
                for row, text in enumerate(part.column(1)):
                    whole = coder.encode(text.as_py()) + end
                    for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                        piece = whole[at : at + 4 * capacity]
                        rows.append(row)
                        number.append(k)
                        starts.append(at // 4)
                        lengths.append(len(piece) // 4)
                        crcs.append(zlib.crc32(piece))
                        if ids:
                            kept.append(piece)
                columns = [
                    part.column(0).take(pa.array(rows, pa.int32())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, schema)


def patterns(bins: list[int], total: int, most: int = PARTS) -> list[tuple[int, ...]]:
    """Multisets of at most ``most`` of the given bins that fill ``total``, or to which no more bin fits."""
    found = []

    def extend(chosen: tuple[int, ...], left: int, at: int):
        fits = [k for k in range(at, len(bins)) if bins[k] <= left]
        if chosen and (len(chosen) == most or not any(b <= left for b in bins)):
            if left == 0 or len(chosen) < most:
                found.append(chosen)
            return
        for k in fits:
            extend((*chosen, bins[k]), left - bins[k], k)

    extend((), total, 0)
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3) -> np.ndarray:
    """argmin |a x - b| over x >= 0 (the active-set method of Lawson and Hanson)."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    for _ in range(rounds * n):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-7 * max(1.0, np.abs(b).max()):
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if solved.min() > 0:
                x[:] = 0
                x[at] = solved
                break
            low = solved <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - solved[low], 1e-300))
            x[at] += step * (solved - x[at])
            gone = at[x[at] <= 1e-12]
            gone = gone if len(gone) else at[low][:1]
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
    return x


class Stock:
    """Counts of pieces by length."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()

    def longest(self, most: int, least: int = 1) -> int:
        """The longest length in [least, most] that is left, or 0."""
        if most < least:
            return 0
        found = np.flatnonzero(self.left[least : most + 1])
        return int(found[-1]) + least if len(found) else 0

    def combine(self, start: list[int], room: int) -> tuple[list[int], int]:
        """Fill ``room`` beside ``start`` by best fit: the lengths, and how often the stock holds them all."""
        chosen, used = list(start), {}
        for s in start:
            used[s] = used.get(s, 0) + 1
        while room > 0:
            fit = self.longest(room)
            while fit and self.left[fit] <= used.get(fit, 0):
                fit = self.longest(fit - 1)
            if not fit:
                break
            chosen.append(fit)
            used[fit] = used.get(fit, 0) + 1
            room -= fit
        return chosen, int(min(self.left[s] // n for s, n in used.items()))

    def take(self, chosen: list[int], times: int):
        for s in chosen:
            self.left[s] -= times


def plan(counts: np.ndarray, capacity: int, bins: int = BINS) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences each fills; together they use every piece.

    ``counts[n]`` is the number of pieces of length n.
    """
    stock, out = Stock(counts), []
    width = -(-capacity // bins)
    of = -(-np.arange(capacity + 1) // width)
    histogram = np.bincount(of, counts[: capacity + 1], minlength=bins + 1)
    present = [int(b) for b in np.flatnonzero(histogram) if b]
    shapes = patterns(present, capacity // width) if present else []
    if shapes:
        matrix = np.zeros((len(present), len(shapes)))
        row = {b: k for k, b in enumerate(present)}
        for k, shape in enumerate(shapes):
            for b in shape:
                matrix[row[b], k] += 1
        repeats = np.floor(nnls(matrix, histogram[present].astype(float)) + 1e-6).astype(np.int64)
        # long first parts first: what comes later fills up with what is short
        for k in sorted(np.flatnonzero(repeats), key=lambda k: sorted(shapes[k], reverse=True), reverse=True):
            wanted, shape = int(repeats[k]), sorted(shapes[k], reverse=True)
            while wanted:
                start, used = [], {}
                for b in shape[:-1] or shape:
                    high = b * width
                    fit = stock.longest(min(high, capacity), high - width + 1)
                    while fit and stock.left[fit] <= used.get(fit, 0):
                        fit = stock.longest(fit - 1, high - width + 1)
                    if not fit:
                        break
                    start.append(fit)
                    used[fit] = used.get(fit, 0) + 1
                else:
                    chosen, times = stock.combine(start, capacity - sum(start))
                    times = min(times, wanted)
                    stock.take(chosen, times)
                    out.append((chosen, times))
                    wanted -= times
                    continue
                break  # the bins of this pattern are used up
    while longest := stock.longest(capacity):
        chosen, times = stock.combine([longest], capacity - longest)
        stock.take(chosen, times)
        out.append((chosen, times))
    return out


def slots(planned: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, low, high, sequence, offset): pieces low..high-1 of a length go to consecutive sequences."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for chosen, times in planned:
        offset = 0
        for n in chosen:
            low = used.get(n, 0)
            out.append((n, low, low + times, sequence, offset))
            used[n] = low + times
            offset += n
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset."""
    spark = pieces.sparkSession
    numbered = number_within(pieces, "length", ["doc_id", "piece"], "_p_rank")
    counts = np.zeros(capacity + 1, np.int64)
    for row in numbered.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    found = slots(plan(counts, capacity))
    table = spark.createDataFrame(found, "_p_length long, _p_low long, _p_high long, _p_sequence long, offset long")
    inside = (F.col("length") == F.col("_p_length")) & (F.col("_p_rank") >= F.col("_p_low")) & (F.col("_p_rank") < F.col("_p_high"))
    joined = numbered.join(broadcast_bounded(table, len(found)), inside)
    return joined.withColumn("sequence_id", F.col("_p_sequence") + F.col("_p_rank") - F.col("_p_low")).drop(
        "_p_rank", "_p_length", "_p_low", "_p_high", "_p_sequence"
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, ids: bool = False) -> DataFrame:
    """Cut and pack (doc_id, text): one row per piece with its sequence and offset; ``ids`` adds the token ids."""
    pieces = materialize(cut_documents(docs, path, capacity, end_id, ids=ids), "pack-pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) with the pieces in place; a sequence has ``capacity`` ids at most. Needs ``ids``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))
