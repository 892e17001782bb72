"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A text is the set of its n-word shingles, each a 64-bit hash; the order of the hashes is the
global n-gram order. Cutting it into fragments cuts every set into segments.

Candidates. Let t be the threshold and d(x) = (1 - t) / t * |x|: no partner of x differs from
it in more than d(x) shingles, so at most d(x) of its s segments hold any difference and the other
s - d(x), or more, are equal in both. Hence a set with fewer than s - d(x) segments that any other set
has as well links with nothing; it leaves, its segments become rarer, and further sets may leave. What
remains ranks its segments by the number of their owners (rarest first, then by hash), an order that
is the same for all; the best-ranked equal segment of a link is among the first d(x) + 1 of either
set, so the s - d(x) - 1 most common ones are left out. No pair is lost, and a passage that
very many texts share joins nobody unless it fills most of them. The number of fragments depends on a
size class; a set close to the end of its class also enters the next one.

Equal sets are one class from the start (128-bit digest of the set), found by an aggregation
that combines map-side, so any number of copies costs one row. Sets that share ranked segments form
loose groups (components of the bipartite graph, over one edge per membership); every link lies
inside a loose group.

Counting. A loose group is cut into blocks of ``BLOCK`` sets, and a task sees two blocks, so a
group of any size is split. In the task every fragment of the order is counted by itself: the
segments of one block meet the postings of the other, which gives a matrix of partial
overlaps; the matrices are summed per pair, and the sums decide. No pair leaves a task: it
returns a spanning forest of its links, at most one row per set.

Edge cases: null texts and texts without words have no shingles and link with nothing; a
text with fewer than n words is one shingle, the whole sequence; rows with equal texts are copies,
whatever their ids; where ids are null or repeat, rows are told apart by numbers of their own and
the component is named by its smallest id that is not null; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import by_ids, with_keys
from docloom.llm.words import LOWER, ODD, hash_words, mix, shingles, texts_of
from docloom.operators.components import connected_components
from docloom.operators.corpus import number_within
from docloom.runtime import BROADCAST_BYTES, forget, materialize

CLASS_GROWTH = 1.5  # largest over smallest size in a class
SPARE = 1.3  # fragments per allowed difference
PART_BITS = 3  # 2^3 fragments in the counting
BLOCK = 512  # sets in a block of a loose group
EXPAND = 2_000_000
SETTLED = 0.1  # share of memberships that must leave for another look


def classes_of(size: int, num: int, den: int) -> list[tuple[int, int]]:
    """(class, fragments) that a set of this size enters: its own, and the next if a partner can be there."""
    own = int(np.floor(np.log(size) / np.log(CLASS_GROWTH) + 1e-9))
    found = []
    for c in (own, own + 1):
        first = int(np.ceil(CLASS_GROWTH**c - 1e-9))
        if c > own and size * den < first * num:
            break
        last = CLASS_GROWTH ** (c + 1)
        found.append((c, 2 + int(np.ceil(SPARE * last * (den - num) / num))))
    return found


def segment_hashes(grams: np.ndarray, num: int, den: int) -> list[tuple[int, np.ndarray]]:
    """(needed, hashes of all segments) of a set (sorted, distinct 64-bit shingles) in each of its classes.

    A partner has at least ``needed`` of these segments.
    """
    size = len(grams)
    allowed = size * (den - num) // num
    if not allowed:  # only an equal set can link
        return []
    out = []
    for c, fragments in classes_of(size, num, den):
        # fragment of a gram: its place in the order of hashes, cut into equal ranges
        place = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        content = mix(np.add.reduceat(mix(grams ^ ODD), starts) + place[starts] * ODD + np.uint64(c))
        if len(starts) <= allowed:  # a tiny set: some empty segments may be all that is equal
            empty = np.setdiff1d(np.arange(fragments, dtype=np.uint64), place)
            content = np.r_[content, np.sort(mix(empty * ODD + np.uint64(c)))[: allowed + 1 - len(starts)]]
        out.append((max(1, len(starts) - allowed), content))
    return out


def add_sets(docs: DataFrame, n: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, d1, d2, entries): size, digest and, for each class, (needed, segments). Map-only."""
    entry = pa.struct([("needed", pa.int32()), ("segments", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = hash_words()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, first, second, entries = [], [], [], []
                for text in texts_of(part.column(1)):
                    grams = np.unique(shingles(text.translate(LOWER).split(), n, hashes))
                    sizes.append(len(grams))
                    first.append(int(mix(grams).sum(dtype=np.uint64).view(np.int64)) if len(grams) else 0)
                    second.append(int(mix(grams + ODD).sum(dtype=np.uint64).view(np.int64)) if len(grams) else 0)
                    entries.append(segment_hashes(grams, num, den) if len(grams) else [])
                each = [e for own in entries for e in own]
                values = [np.empty(0, np.int64), *(e[1].view(np.int64) for e in each)]
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, values[1:])], dtype=np.int32), pa.array(np.concatenate(values)))
                flat = pa.StructArray.from_arrays([pa.array([e[0] for e in each], pa.int32()), lists], fields=list(entry))
                offsets = np.cumsum([0, *map(len, entries)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), flat),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "entries"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, d1 long, d2 long, entries array<struct<needed:int,segments:array<bigint>>>"
    )


def gram_sets(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(id, grams): the whole set of each text, in order. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = hash_words()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                piece = batch.slice(start, 64)
                grams = [np.unique(shingles(t.translate(LOWER).split(), n, hashes)).view(np.int64) for t in texts_of(piece.column(1))]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(grams, pa.list_(pa.int64()))], names=["id", "grams"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, grams array<long>")


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: partial counts of each fragment of the order, summed per pair."""
    total = np.zeros(len(one) * len(two), np.int64)
    bounds = [np.uint64(f << (64 - PART_BITS)) for f in range(1, 1 << PART_BITS)]
    cuts = [[np.r_[0, np.searchsorted(g, bounds), len(g)] for g in side] for side in (one, two)]
    for f in range(1 << PART_BITS):
        sides = []
        for sets, cut in zip((one, two), cuts):
            parts = [g[c[f] : c[f + 1]] for g, c in zip(sets, cut)]
            sides.append((np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])))
        (left, rows), (right, owners) = sides
        order = np.argsort(right, kind="stable")
        right, owners = right[order], owners[order]
        low, high = np.searchsorted(right, left, "left"), np.searchsorted(right, left, "right")
        met = high > low
        low, counts, rows = low[met], (high - low)[met], rows[met]
        ends = np.cumsum(counts)
        begin = 0
        while begin < len(counts):  # postings of at most EXPAND pairs at a time, or of one gram
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + EXPAND)))
            k = counts[begin:stop]
            at = np.repeat(low[begin:stop] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            total += np.bincount(np.repeat(rows[begin:stop], k) * len(two) + owners[at], minlength=len(total))
            begin = stop
    return total.reshape(len(one), len(two))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric link matrix."""
    left, found = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        if not left[start]:
            continue
        left[start] = False
        stack = [start]
        while stack:
            u = stack.pop()
            near = np.flatnonzero(linked[u] & left)
            left[near] = False
            found += [(u, int(v)) for v in near]
            stack += near.tolist()
    return found


def group_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """(src, dst): a spanning forest of the links inside each loose group. Rows: (group, place, id, grams)."""
    rows = members.withColumn("block", F.floor(F.col("place") / BLOCK).cast("int"))
    lasts = rows.groupBy("group").agg(F.max("block").alias("last"))
    one = F.struct("id", "grams", "block").alias("row")
    # a set goes to the tasks of (its block, any block of its group)
    paired = rows.join(lasts, "group").select("group", "last", one, F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    b1, b2 = F.least("row.block", "other"), F.greatest("row.block", "other")
    # groups of one block share a task with others: there are many small ones
    bins = max(1, rows.count() // (4 * BLOCK))
    unit = F.when(F.col("last") == 0, F.struct(F.pmod(F.xxhash64("group"), F.lit(bins)).alias("u"), F.lit(-1).alias("b1"), F.lit(-1).alias("b2")))
    unit = unit.otherwise(F.struct(F.xxhash64("group").alias("u"), b1.alias("b1"), b2.alias("b2")))
    paired = paired.select(unit.alias("unit"), "group", b1.alias("b1"), b2.alias("b2"), "row.*")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, block = table.column("id").combine_chunks(), table.column("block").to_numpy()
        lists = table.column("grams").combine_chunks()
        flat, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        keys = np.stack([table.column(c).to_numpy() for c in ("group", "b1", "b2")], 1)
        order = np.lexsort(keys.T[::-1])
        starts = np.flatnonzero(np.r_[True, (np.diff(keys[order], axis=0) != 0).any(1)])
        source, target = [], []
        for at in np.split(order, starts[1:]):
            grams = [flat[offsets[i] : offsets[i + 1]] for i in at]
            sizes = np.array([len(g) for g in grams])
            mine, other = keys[at[0], 1], keys[at[0], 2]
            first, second = np.flatnonzero(block[at] == mine), np.flatnonzero(block[at] == other)
            both = overlaps([grams[i] for i in first], [grams[i] for i in second])
            close = both * den >= (sizes[first][:, None] + sizes[second][None, :] - both) * num
            linked = np.zeros((len(at), len(at)), bool)
            linked[np.ix_(first, second)] = close
            linked |= linked.T
            for u, v in forest(linked):
                source.append(at[u])
                target.append(at[v])
        take = [pa.array(np.array(side, np.int64)) for side in (source, target)]
        return pa.table({"src": ids.take(take[0]), "dst": ids.take(take[1])})

    kind = members.schema["id"].dataType.simpleString()
    return paired.groupBy("unit").applyInArrow(run, f"src {kind}, dst {kind}")


def link_components(
    docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest id reachable by links of num / den or more."""
    keyed, key = with_keys(docs.select(id_col, text_col), id_col)
    found = _components(keyed, n, num, den, key, text_col).withColumnRenamed("doc_id", key)
    if key != id_col:
        found = by_ids(found, keyed, key, id_col)
    return found.select(F.col(id_col).alias("doc_id"), "n_shingles", "component_id")


def deduplicate(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id."""
    keyed, key = with_keys(docs, id_col)
    found = _components(keyed.select(key, text_col), n, num, den, key, text_col)
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_j_gone")), "join-gone")
    few = gone.count()
    # texts move only when the removed ids are too many to be broadcast
    gone = F.broadcast(gone) if few * 16 <= BROADCAST_BYTES else gone
    return keyed.join(gone, F.col(key) == F.col("_j_gone"), "left_anti").select(*docs.columns)


def loose_groups(sets: DataFrame) -> DataFrame:
    """(_j_id, group) of the sets (doc_id, entries) that may have a partner; written out."""
    entries = sets.select("doc_id", F.posexplode("entries").alias("which", "entry"))
    segments = entries.select("doc_id", "which", F.explode("entry.segments").alias("segment"))
    # all segments move twice, at every size: to count their owners (combined first), and to meet the counts of those with several
    counted = materialize(segments.groupBy("segment").agg(F.count("*").alias("owners")).where("owners > 1"), "join-shared")
    members = materialize(segments.join(counted.hint("merge"), "segment"), "join-members")
    forget(counted)
    needs = entries.select("doc_id", "which", "entry.needed")
    held, rows = None, members.count()
    while True:
        shared = members.groupBy("doc_id", "which").agg(F.count("*").alias("shared"))
        chosen = shared.join(needs, ["doc_id", "which"]).where("shared >= needed")
        before, held = held, materialize(chosen.select("doc_id", "which", (F.col("needed") - 1).alias("spare")), "join-held")
        if before is not None:
            forget(before)
        left = members.drop("owners").join(held.select("doc_id", "which"), ["doc_id", "which"], "left_semi")
        owners = left.groupBy("segment").agg(F.count("*").alias("owners")).where("owners > 1")
        fewer = materialize(left.join(owners, "segment"), "join-members")
        forget(members)
        members, last, rows = fewer, rows, fewer.count()
        if rows >= (1 - SETTLED) * last:
            break
    # a last look at what every set has left, then its rarest segments
    ranked = members.groupBy("doc_id", "which").agg(F.sort_array(F.collect_list(F.struct("owners", "segment"))).alias("by"))
    ranked = ranked.join(held, ["doc_id", "which"]).where(F.size("by") > F.col("spare"))
    marks = ranked.select("doc_id", F.explode(F.slice("by", F.lit(1), F.size("by") - F.col("spare"))["segment"]).alias("segment"))
    marks = materialize(marks, "join-marks")
    low = marks.groupBy("segment").agg(F.min("doc_id").alias("low"))
    edges = marks.join(low, "segment").where("doc_id <> low").select(F.col("low").alias("src"), F.col("doc_id").alias("dst"))
    loose = connected_components(edges)
    grouped = materialize(loose.select(F.col("node").alias("_j_id"), F.col("root").alias("group")), "join-groups")
    for scratch in (members, held, marks):
        forget(scratch)
    return grouped


def _components(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, component_id) for unique ids."""
    if num * 10 < den * 7:
        raise ValueError("thresholds below 0.7 are not served: partners could be two size classes away")
    sets = materialize(add_sets(docs, n, num, den, id_col, text_col), "join-sets")
    facts = materialize(sets.select("doc_id", "n_shingles", "d1", "d2"), "join-facts")
    classes = materialize(
        facts.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep")), "join-classes"
    )
    # copies are taken out by their ids: the sets themselves do not move
    keys = ["n_shingles", "d1", "d2"]
    copies = materialize(facts.join(classes, keys).where("doc_id <> rep").select("doc_id"), "join-copies")
    n_copies = copies.count()
    copies = F.broadcast(copies) if n_copies * 16 <= BROADCAST_BYTES else copies
    grouped = loose_groups(sets.select("doc_id", "entries").join(copies, "doc_id", "left_anti"))
    forget(sets)
    few = grouped.count()
    texts = docs.select(F.col(id_col).alias("_j_doc"), F.col(text_col).alias("_j_text"))
    # texts of the grouped documents only; they stay where they are when the ids can be broadcast
    ids = grouped.select("_j_id")
    ids = F.broadcast(ids) if few * 16 <= BROADCAST_BYTES else ids
    sets_of = gram_sets(texts.join(ids, F.col("_j_doc") == F.col("_j_id"), "left_semi"), n, "_j_doc", "_j_text")
    placed = number_within(grouped, "group", ["_j_id"], "place")
    found = sets_of.join(placed, F.col("id") == F.col("_j_id")).select("group", "place", "id", "grams")
    grams = materialize(found, "join-grams")
    roots = connected_components(group_links(grams, num, den))
    forget(grams)
    named = classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        "n_shingles", "d1", "d2", F.coalesce("root", "rep").alias("component_id")
    )
    # one row per class on the right: AQE can split a class that holds a third of all rows
    return facts.join(named, keys, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
