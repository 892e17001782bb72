"""Pair work in bounded blocks.

Rows are spread over blocks by a hash of their id; each pair of blocks becomes one
grouped-map call on at most about two blocks of rows. No candidate pair ever becomes a
row: a kernel sees two matrices and returns only what the operator needs.

A row travels once for every block it meets. So blocks are not small: there are ``BLOCKS`` of them, enough tasks for
many cores, and what travels grows with the rows, until a block of vectors reaches ``BLOCK_BYTES``. Only from there
on blocks get more, and travel grows with the square. Kernels work through a pair of blocks in small pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import kernels

BLOCK_ROWS = 2048
BLOCKS = 16
BLOCK_BYTES = 32 * 1024 * 1024
TRIED = 2000  # rows on which the number of anchors is decided, never a result


def rows_of_a_block(df: DataFrame, rows: int, results: int = 0) -> int:
    """Rows of a block for ``rows`` vectors: ``BLOCK_ROWS`` at least, ``BLOCK_BYTES`` of vectors or of their ``results`` at most."""
    first = df.select(F.size("vec").alias("d")).first()
    width = max(1, first["d"] if first else 1, 4 * results)
    return max(BLOCK_ROWS, min(math.ceil(rows / BLOCKS), BLOCK_BYTES // (8 * width)))


def block_count(rows: int, block_rows: int) -> int:
    """Number of blocks that hold ``rows`` rows."""
    return max(1, math.ceil(rows / block_rows))


def block_of(id_col: str, blocks: int) -> Column:
    """Even, reproducible block number from the id."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).cast("int")


def _range(count: int) -> Column:
    return F.sequence(F.lit(0), F.lit(count - 1))


def triangle(
    df: DataFrame,
    kernel: Callable[[pd.DataFrame, pd.DataFrame | None], pd.DataFrame],
    schema: str,
    rows: int,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Call ``kernel(a, b)`` for every unordered pair of blocks; ``b`` is None on the diagonal.

    ``df`` needs a unique column ``id``. Each row travels once per block.
    """
    blocks = block_count(rows, block_rows)
    own, other = F.col("_own"), F.col("_other")
    spread = (
        df.withColumn("_own", block_of("id", blocks))
        .withColumn("_other", F.explode(_range(blocks)))
        .withColumn("_low", F.least(own, other))
        .withColumn("_high", F.greatest(own, other))
        .withColumn("_upper", own > other)
        .drop("_own", "_other")
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        upper = group["_upper"].to_numpy()
        diagonal = group["_low"].iloc[0] == group["_high"].iloc[0]
        low_side = group[~upper].sort_values("id")
        high_side = group[upper].sort_values("id")
        return kernel(low_side, None if diagonal else high_side)

    return spread.groupBy("_low", "_high").applyInPandas(run, schema)


def rectangle(
    left: DataFrame,
    right: DataFrame,
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    left_rows: int,
    right_rows: int,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Call ``kernel(a, b)`` for every left block and every right block; both have ``id``."""
    lefts, rights = block_count(left_rows, block_rows), block_count(right_rows, block_rows)
    a = left.withColumn("_l", block_of("id", lefts)).withColumn("_r", F.explode(_range(rights)))
    b = right.withColumn("_r", block_of("id", rights)).withColumn("_l", F.explode(_range(lefts)))
    return _two_sided(a, b, ["_l", "_r"], kernel, schema)


def _two_sided(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """One grouped-map call per key with the rows of both sides, if both have any.

    A tagged union instead of a cogroup: both sides may come from the same frame. A column
    that only one side has arrives as float64.
    """
    tagged = left.withColumn("_right", F.lit(False)).unionByName(
        right.withColumn("_right", F.lit(True)), allowMissingColumns=True
    )
    names = [field.strip().split(" ")[0] for field in schema.split(",")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        side = group["_right"].to_numpy(bool)
        if side.all() or not side.any():
            return pd.DataFrame({name: [] for name in names})
        return kernel(group[~side].sort_values("id"), group[side].sort_values("id"))

    return tagged.groupBy(*keys).applyInPandas(run, schema)


def anchor_count(rows: int, anchors: int | None = None) -> int:
    """About one anchor per 20,000 rows, at most 512, unless given."""
    return anchors or max(1, min(512, rows // 20_000))


def anchored(
    df: DataFrame,
    eps: float,
    rows: int,
    anchors: int | None = None,
) -> DataFrame:
    """Add ``home`` and ``reach`` (anchor numbers) to rows of (id, vec, ...).

    Anchors are the rows with the smallest id hash, so the driver holds a small matrix.
    With more than one anchor the caller should materialize the result before reuse.
    """
    wanted = anchor_count(rows, anchors)
    if wanted == 1:
        none = F.array().cast("array<int>")
        return df.withColumn("home", F.lit(0)).withColumn("reach", none)
    if anchors is None and wanted > BLOCKS // 2:
        # anchors that keep few rows apart only add copies: each row would travel to half of them
        tried = _placed(df.orderBy(F.xxhash64("id", F.lit(1))).limit(TRIED), df, eps, wanted)
        if (tried.agg(F.avg(F.size("reach"))).first()[0] or 0.0) > BLOCKS // 2:
            wanted = BLOCKS // 2
    return _placed(df, df, eps, wanted)


def _placed(rows: DataFrame, df: DataFrame, eps: float, wanted: int) -> DataFrame:
    """``anchored`` for some rows of ``df``, whose first ``wanted`` by hash are the anchors."""
    picked = df.orderBy(F.xxhash64("id"), "id").limit(wanted).select("vec").collect()
    matrix = df.sparkSession.sparkContext.broadcast(
        kernels.stack(pd.Series([row["vec"] for row in picked]))
    )

    @F.pandas_udf("home int, reach array<int>")
    def place(vec: pd.Series) -> pd.DataFrame:
        home, reach = kernels.anchors_of(kernels.stack(vec), matrix.value, eps)
        return pd.DataFrame({"home": home, "reach": reach})

    return (
        rows.withColumn("_place", place("vec"))
        .withColumn("home", F.col("_place.home"))
        .withColumn("reach", F.col("_place.reach"))
        .drop("_place")
    )


def anchor_blocks(
    placed: DataFrame, rows: int, anchors: int | None = None, block_rows: int | None = None
) -> tuple[list[int], list[int]]:
    """Per anchor the number of blocks for its own rows and for all rows that reach it."""
    block_rows = block_rows or rows_of_a_block(placed, rows)
    wanted = anchor_count(rows, anchors)
    if wanted == 1:
        return [block_count(rows, block_rows)], [block_count(rows, block_rows)]
    sizes = (
        placed.select("home", F.explode(F.concat(F.array("home"), F.col("reach"))).alias("anchor"))
        .groupBy("anchor")
        .agg(F.count_if(F.col("anchor") == F.col("home")).alias("homes"), F.count("*").alias("all"))
        .collect()
    )
    home_blocks, member_blocks = [1] * wanted, [1] * wanted
    for row in sizes:
        home_blocks[row["anchor"]] = block_count(row["homes"], block_rows)
        member_blocks[row["anchor"]] = block_count(row["all"], block_rows)
    return home_blocks, member_blocks


def neighbour_groups(
    placed: DataFrame,
    sizes: tuple[list[int], list[int]],
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Call ``kernel(homes, members)`` so that all pairs within eps meet exactly once.

    ``placed`` comes from ``anchored`` and ``sizes`` from ``anchor_blocks``. A crowded anchor is cut into sub-blocks on both sides, so a hot spot becomes more
    groups, never a larger one.
    """
    member = placed.withColumn("anchor", F.explode(F.concat(F.array("home"), F.col("reach"))))
    home_blocks, member_blocks = sizes

    def per_anchor(counts: list[int], anchor: str) -> Column:
        return F.element_at(F.lit(counts), F.col(anchor) + 1)

    # Different seeds keep a row's home block and member block independent.
    hash_home, hash_member = F.xxhash64("id", F.lit(1)), F.xxhash64("id", F.lit(2))
    homes = (
        placed.withColumn("anchor", F.col("home"))
        .withColumn("_hb", F.pmod(hash_home, per_anchor(home_blocks, "anchor")).cast("int"))
        .withColumn("_mb", F.explode(F.sequence(F.lit(0), per_anchor(member_blocks, "anchor") - 1)))
        .drop("reach")
    )
    members = (
        member.withColumn("_mb", F.pmod(hash_member, per_anchor(member_blocks, "anchor")).cast("int"))
        .withColumn("_hb", F.explode(F.sequence(F.lit(0), per_anchor(home_blocks, "anchor") - 1)))
        .drop("reach")
    )
    return _two_sided(homes, members, ["anchor", "_hb", "_mb"], kernel, schema)
