"""Corpus operators: metadata join, de-duplication, filters, positions, token clean-up."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.runtime import BROADCAST_BYTES, broadcast_bounded, materialize

LEMMA_BYTES = 96


def join_metadata(
    papers: DataFrame,
    metadata: DataFrame,
    paper_key: str = "paper_id",
    metadata_key: str = "sha",
    order: str | Column = "meta_order",
) -> DataFrame:
    """Inner join on exact key equality, taking the first metadata row of each key.

    The first row is a ``min_by`` aggregate, so a key with very many rows is combined
    map-side (over a struct, which Spark sorts for); the join then meets at most one metadata
    row per key.
    """
    skipped = {metadata_key, order} if isinstance(order, str) else {metadata_key}
    payload = [c for c in metadata.columns if c not in skipped]
    first = (
        metadata.where(F.col(metadata_key).isNotNull())
        .groupBy(F.col(metadata_key).alias(paper_key))
        .agg(F.min_by(F.struct(*payload), order).alias("_m"))
        .select(paper_key, "_m.*")
    )
    return papers.join(first, paper_key)


def _fingerprint(columns: Sequence[str]) -> list[Column]:
    return [F.sha2(F.col(c).cast("binary"), 256).alias(f"_k{i}") for i, c in enumerate(columns)]


def dedupe(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Of rows that agree on all ``keys`` keep the one with the smallest ``id_col`` (unique).

    Only digests and ids are shuffled to find the copies, with a map-side minimum, so a
    text copied into a third of all rows costs no more than any other. The ids to drop are
    counted: while they are few they are broadcast and the rows stay where they are.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    digests = materialize(df.select(id_col, *_fingerprint(keys)), "digests")
    first = digests.groupBy(*names).agg(F.min(id_col).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    same = [F.col(f"{n}").eqNullSafe(F.col(f"{n}_of")) for n in names]
    right = first.select(*[F.col(n).alias(f"{n}_of") for n in names], "_first")
    copies = digests.join(right, reduce(Column.__and__, same)).where(F.col(id_col) != F.col("_first")).select(id_col)
    copies = materialize(copies, "copies")
    return df.join(broadcast_bounded(copies, copies.count()), id_col, "left_anti")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.na.drop("any")


def filter_language(df: DataFrame, language: str = "en", column: str = "language") -> DataFrame:
    """Keep one language. Apply it before text work so that it reaches the scan."""
    return df.where(F.col(column) == language)


def language_counts(df: DataFrame, column: str = "language") -> DataFrame:
    """Rows per language."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def describe_text(df: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """count, unique, top and freq of each text column, one row per column.

    Values are counted by digest; only the winner's text is looked up. Of equally frequent
    values the one that appears first by ``id_col`` is the top.
    """

    def one(name: str) -> DataFrame:
        rows = df.where(F.col(name).isNotNull())
        per_value = (
            rows.select(F.sha2(F.col(name).cast("binary"), 256).alias("k"), F.col(id_col).alias("i"))
            .groupBy("k")
            .agg(F.count("*").alias("c"), F.min("i").alias("first"))
        )
        summary = per_value.agg(
            F.sum("c").alias("count"),
            F.count("*").alias("unique"),
            F.max("c").alias("freq"),
            F.min_by("first", F.struct(-F.col("c"), F.col("first"))).alias("_first"),
        )
        # one row by construction
        found = rows.select(F.col(id_col).alias("_first"), F.col(name).alias("top")).join(
            F.broadcast(summary), "_first"
        )
        return found.select(F.lit(name).alias("column"), "count", "unique", "top", "freq")

    return reduce(DataFrame.unionByName, [one(c) for c in columns])


def with_row_id(
    df: DataFrame, order: Sequence[str], name: str = "row_id", start: int = 1
) -> DataFrame:
    """Dense ids in the global order of ``order`` (a total order: include a unique column).

    A range-partitioned sort gives every row its place inside its partition; that place and
    the partition number are written out with the rows, so the second pass cannot see a
    different layout. Adding the sizes of the earlier partitions gives the global number.
    No partition ever holds more than its range.
    """
    # monotonically_increasing_id is (partition << 33) + place in partition
    placed = materialize(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mid", 33).cast("int"))
        .withColumn("_place", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid"),
        "ranged",
    )
    sizes = placed.groupBy("_part").count().orderBy("_part").collect()
    offsets, seen = [], start
    for row in sizes:
        offsets.append((row["_part"], seen))
        seen += row["count"]
    table = df.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    # one row per partition of the sort
    return (
        placed.join(F.broadcast(table), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def number_within(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 in the order of ``order``, without gathering a group in one task.

    Rows are dealt by ranges of (group, order); the sizes of a group's pieces in the ranges give
    the offsets. The numbered rows are written once, so that both passes see the same layout.
    ``order`` must be unique within a group for a result that does not depend on the layout.
    """
    local = materialize(
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_n_part", F.spark_partition_id())
        .withColumn("_n_at", F.monotonically_increasing_id()),
        "numbered",
    )
    pieces = local.groupBy(group, "_n_part").agg(F.count("*").alias("_n_rows"), F.min("_n_at").alias("_n_first"))
    earlier = Window.partitionBy(group).orderBy("_n_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n_rows").over(earlier), F.lit(0))
    pieces = pieces.select(F.col(group).alias("_n_group"), F.col("_n_part").alias("_n_of"), "_n_first", before.alias("_n_before"))
    # one row for each group and partition
    same = F.col(group).eqNullSafe(F.col("_n_group")) & (F.col("_n_part") == F.col("_n_of"))
    return (
        local.join(pieces, same)
        .withColumn(name, F.col("_n_before") + F.col("_n_at") - F.col("_n_first"))
        .drop("_n_part", "_n_at", "_n_first", "_n_before", "_n_group", "_n_of")
    )


# Up to this many rows per group Spark limits a rank in the map tasks (its own threshold).
MAP_LIMIT = 1000


def first_in_group(df: DataFrame, group: str, order: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group by ascending ``order`` (unique), with their rank from 1.

    Small ``n``: the rank is limited inside the map tasks before the shuffle. Large ``n``: rows
    are numbered in ranges. Both ways give the same rows.
    """
    if n <= MAP_LIMIT:
        ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    else:
        ranked = number_within(df, group, order, name).withColumn(name, (F.col(name) + 1).cast("int"))
    return ranked.where(F.col(name) <= n)


def zip_by_position(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str],
    right_order: Sequence[str],
    name: str = "position",
) -> DataFrame:
    """Pair the i-th row of one frame with the i-th row of the other, from 0."""
    a = with_row_id(left, left_order, name, start=0)
    b = with_row_id(right, right_order, name, start=0)
    return a.join(b, name)


def union_parts(*parts: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, parts)


def clean_tokens(df: DataFrame, column: str = "tokens") -> DataFrame:
    """Drop all-digit and empty tokens, then rows left without any token.

    Token order is kept and nothing is shuffled. Exploding a list of at most one token list
    drops the empty ones; a filter would make Spark compute the tokens twice, once for the
    predicate it pushes down and once for the output.
    """
    kept = F.filter(F.array(tx.drop_empty(tx.drop_numeric(F.col(column)))), lambda t: F.size(t) > 0)
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, F.explode(kept).alias(column))


def lemmatize(
    df: DataFrame,
    lemmas: DataFrame,
    id_col: str = "doc_id",
    column: str = "tokens",
    words: Sequence[str] | None = None,
) -> DataFrame:
    """Replace tokens by their lemma (lower, stripped) and rejoin them: (id, text).

    With ``words`` (stop words) the lemmas that are stop words or punctuation are left out
    before the text is joined; a document of which nothing is left keeps an empty text.

    ``lemmas`` is (token, lemma), one row per token; a token without entry, or whose lemma
    is null (pronouns), keeps its surface form. While the table, which is counted, is small it
    travels to the tasks, tokens are looked up where they are, and one row per document is
    shuffled, since rows of the same id are one text. A larger one is joined by shuffle, where AQE
    splits frequent tokens.
    """
    table = lemmas.select("token", F.trim(F.lower("lemma")).alias("_lemma"))
    if lemmas.count() * LEMMA_BYTES <= BROADCAST_BYTES:
        grouped = _looked_up(df.select(id_col, column), table, id_col, column)
    else:
        # exploding an expression: for a bare column Spark would add a filter on its size and
        # compute the tokens a second time for it
        pairs = F.transform(column, lambda t: F.struct(t.alias("token"), F.lower(t).alias("low")))
        pieces = (
            df.select(id_col, column)
            .repartition(id_col)
            .select(id_col, F.posexplode(pairs).alias("_pos", "_p"))
            .select(id_col, "_pos", "_p.token", "_p.low")
        )
        listed = (
            pieces.join(table, "token", "left")
            .select(id_col, F.struct("_pos", F.coalesce("_lemma", "low").alias("w")).alias("p"))
            .groupBy(id_col)
        )
        grouped = listed.agg(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["w"]).alias("_ws"))
    in_order = F.col("_ws")
    if words is not None:
        in_order = tx.drop_punctuation(tx.remove_stop_words(in_order, list(words)))
    return grouped.select(id_col, F.array_join(in_order, " ").alias("text"))


def _looked_up(df: DataFrame, table: DataFrame, id_col: str, column: str) -> DataFrame:
    """(id, _ws): the lemmas of an id's tokens by position; ids without tokens are left out."""
    shared = df.sparkSession.sparkContext.broadcast({r["token"]: r["_lemma"] for r in table.collect() if r["_lemma"] is not None})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            tokens = batch.column(1)
            flat = tokens.flatten().dictionary_encode()  # each different token of a batch once
            found = pa.array([known.get(t) for t in flat.dictionary.to_pylist()], pa.string()).take(flat.indices)
            ends = pa.array(np.concatenate([[0], tokens.value_lengths().fill_null(0).to_numpy().cumsum()]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, found)], names=[id_col, "_tokens", "_found"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.mapInArrow(run, f"`{id_col}` {kind}, _tokens array<string>, _found array<string>").where(F.size("_tokens") > 0)
    lists = rows.groupBy(id_col).agg(F.collect_list(F.zip_with("_tokens", "_found", lambda t, w: F.coalesce(w, F.lower(t)))).alias("_rows"))
    placed = F.flatten(F.transform("_rows", lambda row: F.transform(row, lambda w, i: F.struct(i.alias("i"), w.alias("w")))))
    merged = F.transform(F.sort_array(placed), lambda p: p["w"])
    return lists.select(id_col, F.when(F.size("_rows") == 1, F.get("_rows", F.lit(0))).otherwise(merged).alias("_ws"))


def _md5_number(*parts: Column) -> Column:
    """32-bit number from an md5 digest: even, and the same in every engine."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def sample_docs(df: DataFrame, fraction: float, seed: int, id_col: str = "doc_id") -> DataFrame:
    """Sample without replacement. A row's fate depends on its id and the seed alone."""
    return df.where(_md5_number(F.col(id_col), F.lit(seed)) < F.lit(int(fraction * 2**32)))


def sample_n(df: DataFrame, n: int, reps: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """``reps`` independent samples of ``n`` ids: (rep, id).

    No repetition meets in one task, however large ``n`` is; see ``first_in_group``.
    """
    draws = df.select(id_col, F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep")).withColumn(
        "_draw", _md5_number(F.col(id_col), F.col("rep"), F.lit(seed))
    )
    return first_in_group(draws, "rep", ["_draw", id_col], n).select("rep", id_col)
