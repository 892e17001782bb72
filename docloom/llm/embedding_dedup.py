"""Near-duplicate vectors by sorted projection passes.

In every pass each vector gets a key: the signs of random projections, concatenated. Sorting
by the key puts close vectors next to each other; each is compared with the ``WINDOW``
rows that follow it, and pairs with a cosine of ``least`` or more are kept, as a spanning forest of each run
of rows. Verified pairs of all passes are united into components.

How many passes a vector needs follows from the density around it, which every pass measures: a partner at the
threshold shares the first m signs with probability (1 - angle / pi)^m, and the signs that a row shares with the
rows at either end of its window say how many are enough to meet it there. A row leaves when the chance that all its passes missed a
partner is below ``MISS``. The first round has as many passes as evenly spread vectors need. Rows that are left, those of dense
regions, go through further rounds among themselves with windows that widen by ``WIDEN``; a partner that left
earlier has met them with its own certainty. What windows of ``WIDEST`` rows leave is compared completely, in blocks.

Windows bound the work of a pass, not the result: every component is compared within itself
completely afterwards, as pairs of blocks of at most ``BLOCK`` vectors that return one count per
vector. So a group of any size has exact link counts, and no pair list arises. Equal
vectors are one vector with a number of copies from the start.

Cosines are computed in double precision. Edge cases: vectors that are null, empty, zero or hold
null or non-finite components link with nothing; vectors of other lengths than most are
compared with those of their own length only; where ids are null or repeat, rows are told apart by
numbers of their own, the component is named by its smallest id that is not null, and one row of the
component is kept, that of the smallest number; labels and other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import by_ids, with_keys
from docloom.operators.components import connected_components
from docloom.operators.corpus import number_within
from docloom.runtime import materialize

WINDOW = 48
MISS = 0.005
BLOCK = 1024
KEY_BITS = 32
SEED = 11
WIDEN, WIDEST, MORE_PASSES = 4, 4096, 12
SURE = -50.0  # log of the chance to miss a partner that cannot be missed


def passes_for(n: int, least: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has been in a common window with probability 1 - miss.

    Two vectors at angle a agree in a sign with probability 1 - a / pi; a window of w rows
    among n is what the first log2(n / w) signs leave together.
    """
    bits = max(0.0, math.log2(max(n, 2) / window)) + 1
    meet = (1 - math.acos(least) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log(1 - meet))) if meet < 1 else 1


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): usable vectors as arrays of double of length one."""
    x = F.col(vec_col).cast("array<double>")
    kept = F.col(vec_col).isNotNull() & (F.size(x) > 0)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    # scaled by the largest component first: squares neither vanish nor overflow
    peak = F.aggregate(x, F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
    rows = vectors.select(F.col(id_col).alias("id"), x.alias("x"), peak.alias("peak")).where(kept & finite & (F.col("peak") > 0))
    scaled = F.transform("x", lambda v: v / F.col("peak"))
    rows = rows.select("id", scaled.alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    return rows.select("id", "x", norm.alias("norm")).select("id", F.transform("x", lambda v: v / F.col("norm")).alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of vectors of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, column: int):
    """Row numbers grouped by the length of their vector."""
    lengths = np.diff(batch.column(column).offsets.to_numpy())
    for d in np.unique(lengths):
        yield int(d), np.flatnonzero(lengths == d)


def projection_keys(units: DataFrame, passes: int, turn: int = 0) -> DataFrame:
    """(pass, key, id, vec), one row for each vector and pass; the key orders as the signs in a row do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {}
        for batch in batches:
            for d, rows in _by_length(batch, 1):
                part = batch.take(pa.array(rows))
                x = _matrix(part.column(1))
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED + d, turn]).normal(size=(passes, d, KEY_BITS))
                for p in range(passes):
                    signs = (x @ planes[d][p] >= 0).astype(np.int64)
                    key = signs @ (1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), d * passes + p, np.int64)), pa.array(key), *part.columns],
                        names=["pass", "key", "id", "vec"],
                    )

    kind = units.schema["id"].dataType.simpleString()
    return units.select("id", "vec").mapInArrow(run, f"pass long, key long, id {kind}, vec array<double>")


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that two keys have in common."""
    return KEY_BITS - np.frexp((a ^ b).astype(np.float64))[1]


def log_miss(keys: np.ndarray, window: int, least: float, open_start: bool, open_end: bool) -> np.ndarray:
    """For each row of a sorted run, log of the chance that a partner at cosine ``least`` is outside its window.

    A partner whose first other sign is the d-th lies after the row if the row's own d-th sign is 0, else before it. It is inside the
    window if d exceeds the signs shared with the row at that end. Beyond an open end of the run nothing is known.
    """
    n, agree = len(keys), 1 - math.acos(least) / math.pi
    unknown = KEY_BITS
    after, before = np.full(n, unknown if open_end else -1), np.full(n, unknown if open_start else -1)
    if n > window:
        after[:-window] = before[window:] = shared_bits(keys[:-window], keys[window:])
    meet = agree ** (KEY_BITS * 1.0) * ((after < KEY_BITS) & (before < KEY_BITS))
    for d in range(KEY_BITS):
        ends = np.where((keys >> (KEY_BITS - 1 - d)) & 1, before, after)
        meet = meet + agree**d * (1 - agree) * (d > ends)
    with np.errstate(divide="ignore"):
        return np.maximum(np.log1p(-np.minimum(meet, 1.0)), SURE)


def forest(rows: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, smallest row of its component) where they differ: as connected as the pairs, with less than one edge a row."""
    label = np.arange(rows)
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = np.flatnonzero(label != np.arange(rows))
    return moved, label[moved]


def window_links(keyed: DataFrame, least: float, window: int = WINDOW) -> DataFrame:
    """Two kinds of rows: (src, dst) of close rows in sorted order, and (src, null, miss): the ``log_miss`` of a row in a pass.

    Rows are range-partitioned by (pass, key, id). A window does not reach over the end of a
    partition; rows there know it, and other passes make up for it.
    """

    def work(batch: pa.RecordBatch, first: int, last: int, ended: bool) -> Iterator[pa.RecordBatch]:
        """Rows first to last of a buffer that holds their windows, as far as this partition has them."""
        passes, keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        source, target, own_rows, miss = [], [], [], []
        bounds = np.flatnonzero(np.r_[True, passes[1:] != passes[:-1], True])
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            begin, stop = max(lo, first), min(hi, last)
            if begin >= stop:
                continue
            x = _matrix(batch.column(3).slice(lo, hi - lo))
            found = []
            for at in range(begin - lo, stop - lo, 256):
                own, near = x[at : min(at + 256, stop - lo)], x[at : at + 256 + window]
                i, j = np.nonzero(own @ near.T >= least - 1e-9)
                good = (j > i) & (j - i <= window)
                i, j = i[good] + at, j[good] + at
                exact = np.einsum("ij,ij->i", x[i], x[j]) >= least
                found.append((i[exact], j[exact]))
            i, j = (np.concatenate(side) for side in zip(*found))
            row, root = forest(hi - lo, i, j)
            source.append(row + lo)
            target.append(root + lo)
            own_rows.append(np.arange(begin, stop))
            miss.append(log_miss(keys[lo:hi], window, least, lo == 0, ended and hi == batch.num_rows)[begin - lo : stop - lo])
        if source:
            pairs, alone = np.concatenate(source), np.concatenate(own_rows)
            links = ids.take(pa.array(np.concatenate([pairs, alone])))
            others = pa.concat_arrays([ids.take(pa.array(np.concatenate(target))), pa.nulls(len(alone), ids.type)])
            misses = pa.concat_arrays([pa.nulls(len(pairs), pa.float64()), pa.array(np.concatenate(miss))])
            yield pa.RecordBatch.from_arrays([links, others, misses], names=["src", "dst", "miss"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, done = None, 0
        for batch in batches:
            if buffer is not None:
                batch = pa.Table.from_batches([buffer, batch]).combine_chunks().to_batches()[0]
            last = max(done, batch.num_rows - window)
            yield from work(batch, done, last, False)
            cut = max(0, last - window)
            buffer, done = batch.slice(cut), last - cut
        if buffer is not None:
            yield from work(buffer, done, buffer.num_rows, True)

    kind = keyed.schema["id"].dataType.simpleString()
    ordered = keyed.repartitionByRange("pass", "key", "id").sortWithinPartitions("pass", "key", "id")
    return ordered.mapInArrow(run, f"src {kind}, dst {kind}, miss double")


def find_links(classes: DataFrame, n: int, least: float) -> DataFrame:
    """(src, dst): links of (id, vec), ``n`` rows, that connect what is close; rounds until no row may have missed a partner."""
    active, window, turn, found, size = classes.select("id", "vec"), WINDOW, 0, None, n
    while size > 1 and window <= WIDEST:
        passes = passes_for(size, least) if turn == 0 else MORE_PASSES
        links = materialize(window_links(projection_keys(active, passes, turn), least, window), "vec-links")
        pairs = links.where("dst IS NOT NULL").select("src", "dst").distinct()
        found = pairs if found is None else found.unionByName(pairs)
        missed = links.where("dst IS NULL").groupBy("src").agg(F.sum("miss").alias("miss")).where(F.col("miss") > math.log(MISS))
        left = materialize(missed.select(F.col("src").alias("id")), "vec-left")
        size = left.count()
        active = materialize(active.join(left, "id"), "vec-active") if size else active.limit(0)
        window, turn = window * WIDEN, turn + 1
    if size > 1:
        rest = number_within(active.withColumn("root", F.size("vec")), "root", ["id"], "place").withColumn("copies", F.lit(1))
        pairs = _in_blocks(rest, _block_forest(least), "src {0}, dst {0}")
        found = pairs if found is None else found.unionByName(pairs)
    kind = classes.schema["id"].dataType.simpleString()
    return found if found is not None else classes.sparkSession.createDataFrame([], f"src {kind}, dst {kind}")


def _block_forest(least: float):
    def run(table: pa.Table) -> pa.Table:
        block, x = table.column("block").to_numpy(), _matrix(table.column("vec").combine_chunks())
        first = np.flatnonzero(block == table.column("b1")[0].as_py())
        second = np.flatnonzero(block == table.column("b2")[0].as_py())
        i, j = np.nonzero(x[first] @ x[second].T >= least)
        row, root = forest(len(x), first[i], second[j])
        ids = table.column("id").combine_chunks()
        return pa.table({"src": ids.take(pa.array(row)), "dst": ids.take(pa.array(root))})

    return run


def _in_blocks(members: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on every pair of blocks of a component. Rows: (root, place, id, vec, copies).

    A component of b blocks is b * (b + 1) / 2 tasks of two blocks each.
    """
    rows = members.withColumn("block", F.floor(F.col("place") / BLOCK).cast("int"))
    sizes = rows.groupBy("root").agg(F.max("block").alias("last"))
    one = F.struct("block", "id", "vec", "copies").alias("row")
    # each row goes to the pairs (own block, any block)
    paired = rows.join(sizes, "root").select(
        "root", one, F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"), F.col("block").alias("mine")
    )
    paired = paired.select("root", F.least("mine", "other").alias("b1"), F.greatest("mine", "other").alias("b2"), "row.*")
    kind = members.schema["id"].dataType.simpleString()
    return paired.groupBy("root", "b1", "b2").applyInArrow(run, schema.format(kind))


def _links_in_blocks(members: DataFrame, least: float) -> DataFrame:
    """(id, links): links to members of the same component, counting copies. A task returns a count per vector."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        x = _matrix(table.column("vec").combine_chunks())
        copies = table.column("copies").to_numpy()
        ids, links = [], []
        first = np.flatnonzero(block == table.column("b1")[0].as_py())
        second = np.flatnonzero(block == table.column("b2")[0].as_py())
        close = x[first] @ x[second].T
        close = close >= least
        if table.column("b1")[0] == table.column("b2")[0]:
            np.fill_diagonal(close, False)
            sides = [(first, close @ copies[second])]
        else:
            sides = [(first, close @ copies[second]), (second, copies[first] @ close)]
        for at, counted in sides:
            ids.append(table.column("id").combine_chunks().take(pa.array(at)))
            links.append(pa.array(counted.astype(np.int64)))
        return pa.table({"id": pa.concat_arrays(ids), "links": pa.concat_arrays(links)})

    return _in_blocks(members, run, "id {}, links long").groupBy("id").agg(F.sum("links").alias("links"))


def link_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row: links are cosines of ``least`` or more."""
    keyed, key = with_keys(vectors.select(id_col, vec_col), id_col)
    found = _link(keyed, least, key, vec_col)
    if key != id_col:
        found = by_ids(found, keyed, key, id_col)
    return found.select(id_col, "n_links", "component_id", "kept")


def _link(vectors: DataFrame, least: float, id_col: str, vec_col: str) -> DataFrame:
    """The same for unique ids."""
    units = unit_vectors(vectors, id_col, vec_col)
    units = materialize(units.withColumn("digest", F.xxhash64("vec")), "vec-units")
    # equal vectors: digests with the vector's own values, so that a clash cannot join two
    classes = materialize(
        units.groupBy("digest", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vec-classes"
    )
    n = classes.count()
    roots = materialize(connected_components(find_links(classes, n, least)), "vec-roots")
    joined = materialize(classes.join(roots, F.col("id") == F.col("node")).select("root", "id", "vec", "copies"), "vec-members")
    links = materialize(_links_in_blocks(number_within(joined, "root", ["id"], "place"), least), "vec-links")
    named = classes.join(links, "id", "left").join(roots, F.col("id") == F.col("node"), "left").select(
        F.col("digest").alias("_v_digest"), F.col("vec").alias("_v_vec"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
    )
    found = units.join(named, (F.col("digest") == F.col("_v_digest")) & (F.col("vec") == F.col("_v_vec"))).select(
        F.col("id").alias("_v_id"), "n_links", "component_id"
    )
    out = vectors.select(id_col).join(found, F.col(id_col) == F.col("_v_id"), "left")
    component = F.coalesce("component_id", id_col)
    return out.select(
        id_col, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (component == F.col(id_col)).alias("kept"),
    )
