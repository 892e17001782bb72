"""Distances, neighbour joins, DBSCAN and exact silhouettes, all by bounded blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.operators import blocks
from docloom.operators.components import connected_components
from docloom.operators.corpus import sample_n, with_row_id
from docloom.runtime import broadcast_bounded, materialize


def epsilon_join(
    df: DataFrame, eps: float, anchors: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """All unordered pairs of (doc_id, vec) rows at most ``eps`` apart: (id_a, id_b, distance)."""
    rows = df.select(F.col("doc_id").alias("id"), "vec")
    total = rows.count()
    placed = blocks.anchored(rows, eps, total, anchors)
    if blocks.anchor_count(total, anchors) > 1:
        placed = materialize(placed, "anchored")
    sizes, limits = blocks.anchor_blocks(placed, total, anchors, block_rows), np.array([eps])

    def kernel(homes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        a, b, pieces = kernels.level_pairs(homes, members, limits)
        ids, others, found = homes["id"].to_numpy(), members["id"].to_numpy(), []
        for i, j, _ in pieces:
            left, right = ids[i], others[j]
            columns = {"id_a": np.minimum(left, right), "id_b": np.maximum(left, right)}
            found.append(pd.DataFrame(columns | {"distance": kernels.hit_distances(a, b, i, j)}))
        return pd.concat(found)

    schema = "id_a long, id_b long, distance double"
    return blocks.neighbour_groups(placed, sizes, kernel, schema)


def dbscan(
    df: DataFrame,
    eps: float = 1.1,
    min_samples: int | None = None,
    anchors: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """(doc_id, vec) to (doc_id, cluster_id).

    A point with at least ``min_samples`` points within ``eps`` (itself included) is a core
    point; clusters are the connected core points, numbered from 0 by their smallest core
    id; a border point joins the lowest-numbered cluster in reach; noise is -1. The default
    for ``min_samples`` is 2 x dimension - 1.

    Equal vectors are merged first and carry a weight, so masses of copies are one point.
    Neighbours are counted, never listed; from each group of blocks leave only the counts,
    one component root per core point, and the core points seen by non-core points (fewer
    than ``min_samples`` each).
    """
    if min_samples is None:
        min_samples = 2 * df.select(F.size("vec").alias("d")).first()["d"] - 1
    merged = materialize(
        df.groupBy("vec").agg(F.min("doc_id").alias("id"), F.count("*").alias("w")), "merged"
    )
    rows = merged.count()
    placed = blocks.anchored(merged, eps, rows, anchors)
    if blocks.anchor_count(rows, anchors) > 1:
        placed = materialize(placed, "anchored")
    sizes, limits = blocks.anchor_blocks(placed, rows, anchors, block_rows), np.array([eps])

    def count_kernel(homes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        _, _, pieces = kernels.level_pairs(homes, members, limits)
        weight_l, weight_r = homes["w"].to_numpy(float), members["w"].to_numpy(float)
        seen_l, seen_r = np.zeros(len(homes)), np.zeros(len(members))
        for i, j, _ in pieces:
            seen_l += np.bincount(i, weight_r[j], minlength=len(homes))
            seen_r += np.bincount(j, weight_l[i], minlength=len(members))
        ids, seen = np.concatenate([homes["id"], members["id"]]), np.concatenate([seen_l, seen_r])
        return pd.DataFrame({"id": ids[seen > 0], "seen": seen[seen > 0].astype(np.int64)})

    counts = (
        blocks.neighbour_groups(placed, sizes, count_kernel, "id long, seen long")
        .groupBy("id")
        .agg(F.sum("seen").alias("seen"))
    )
    flagged = materialize(
        placed.join(counts, "id", "left")
        .withColumn("core", F.col("w") + F.coalesce("seen", F.lit(0)) >= min_samples)
        .drop("seen"),
        "flagged",
    )

    def edge_kernel(homes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        _, _, pieces = kernels.level_pairs(homes, members, limits)
        left, right = homes["id"].to_numpy(), members["id"].to_numpy()
        core_l, core_r = homes["core"].to_numpy(bool), members["core"].to_numpy(bool)
        links, a, b = kernels.Links(left, right), [], []
        for i, j, _ in pieces:
            both, only_r, only_l = core_l[i] & core_r[j], ~core_l[i] & core_r[j], core_l[i] & ~core_r[j]
            links.join(i[both], j[both])
            a += [left[i[only_r]], right[j[only_l]]]
            b += [right[j[only_r]], left[i[only_l]]]
        node, root = links.edges()
        a, b = np.concatenate([node, *a]), np.concatenate([root, *b])
        return pd.DataFrame({"a": a, "b": b, "border": np.arange(len(a)) >= len(node)})

    edges = materialize(
        blocks.neighbour_groups(flagged, sizes, edge_kernel, "a long, b long, border boolean"),
        "edges",
    )
    roots = connected_components(
        edges.where(~F.col("border")).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    )
    cores = materialize(
        flagged.where("core")
        .select(F.col("id").alias("node"))
        .join(roots, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root")),
        "cores",
    )
    numbers = with_row_id(cores.select("root").distinct(), ["root"], "cluster_id", start=0)
    inside = cores.join(numbers, "root").select(F.col("node").alias("id"), "cluster_id")
    reached = (
        edges.where("border")
        .join(inside.withColumnRenamed("id", "b"), "b")
        .groupBy(F.col("a").alias("id"))
        .agg(F.min("cluster_id").alias("cluster_id"))
    )
    labels = merged.select("id", "vec").join(inside.unionByName(reached), "id", "left")
    if df.count() > rows:
        # Copies take the label of their vector; AQE splits a vector that is hot.
        labels = df.select("doc_id", "vec").join(labels.drop("id"), "vec")
    else:
        labels = labels.withColumnRenamed("id", "doc_id")
    return labels.select("doc_id", F.coalesce("cluster_id", F.lit(-1)).cast("int").alias("cluster_id"))


def silhouette_exact(
    df: DataFrame, block_rows: int | None = None
) -> DataFrame:
    """Mean Euclidean silhouette of (doc_id, vec, cluster_id) as one row (silhouette, clusters).

    Noise (-1) counts as a cluster. Needs every distance by definition, so the work is
    quadratic; it runs block by block and moves only one sum per point and cluster. For
    large data ``cluster.silhouette`` has the linear squared-distance form. Null with fewer
    than two clusters.
    """
    rows = df.select(F.col("doc_id").alias("id"), "vec", F.col("cluster_id").alias("c"))

    def sums(side: pd.DataFrame, total: np.ndarray, names: np.ndarray) -> pd.DataFrame:
        repeated = {c: np.repeat(side[c].to_numpy(), len(names)) for c in ("id", "c")}
        return pd.DataFrame(repeated | {"other": np.tile(names, len(side)), "total": total.ravel()})

    def kernel(low: pd.DataFrame, high: pd.DataFrame | None) -> pd.DataFrame:
        sides = [side.sort_values("c", kind="stable") for side in (low, low if high is None else high)]
        if not all(map(len, sides)):
            return pd.DataFrame({"id": [], "c": [], "other": [], "total": []})
        matrices = [kernels.stack(side["vec"]) for side in sides]
        (names_a, a), (names_b, b) = (np.unique(side["c"].to_numpy(), return_inverse=True) for side in sides)
        to_b, to_a = kernels.cluster_sums(*matrices, a, b)
        found = sums(sides[0], to_b, names_b)
        return found if high is None else pd.concat([found, sums(sides[1], to_a, names_a)])

    n = rows.count()
    if block_rows is None:
        block_rows = blocks.rows_of_a_block(rows, n, rows.select("c").distinct().count())
    per_cluster = (
        blocks.triangle(
            rows, kernel, "id long, c int, other int, total double", n, block_rows
        )
        .groupBy("id", "c", "other")
        .agg(F.sum("total").alias("total"))
    )
    sizes = rows.groupBy(F.col("c").alias("other")).agg(F.count("*").alias("n"))
    own = F.col("c") == F.col("other")
    per_point = (
        per_cluster.join(sizes, "other")
        .groupBy("id", "c")
        .agg(
            F.max(F.when(own, F.col("n"))).alias("n"),
            F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
        )
    )
    spread = F.greatest("a", "b")
    score = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(
        F.when(spread > 0, (F.col("b") - F.col("a")) / spread).otherwise(F.lit(0.0))
    )
    clusters = F.count_distinct("c")
    return per_point.agg(
        F.when(clusters > 1, F.avg(score)).alias("silhouette"), clusters.alias("clusters")
    )


def pairwise_mean_distance(df: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Mean Euclidean distance over all ordered pairs of (doc_id, vec), self pairs included."""
    rows = df.select(F.col("doc_id").alias("id"), "vec")

    def kernel(low: pd.DataFrame, high: pd.DataFrame | None) -> pd.DataFrame:
        a = kernels.stack(low["vec"])
        b, times = (a, 1.0) if high is None else (kernels.stack(high["vec"]), 2.0)
        return pd.DataFrame({"total": [times * sum(gaps.sum() for _, _, gaps in kernels.distance_tiles(a, b))]})

    n = rows.count()
    totals = blocks.triangle(rows, kernel, "total double", n, block_rows or blocks.rows_of_a_block(rows, n))
    return totals.agg((F.sum("total") / F.lit(float(n) * n)).alias("mean_distance"))


def sampled_mean_distance(df: DataFrame, n: int = 100, reps: int = 10, seed: int = 0) -> DataFrame:
    """Mean over ``reps`` samples of ``n`` points of the mean pairwise distance: the usual way
    to choose eps. One bounded group of ``n`` points per repetition."""
    chosen = broadcast_bounded(sample_n(df, n, reps, seed), n * reps)
    points = df.select("doc_id", "vec").join(chosen, "doc_id")

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        x = kernels.stack(group.sort_values("doc_id")["vec"])
        return pd.DataFrame({"rep": [group["rep"].iloc[0]], "mean": [kernels.distances(x, x).mean()]})

    return (
        points.groupBy("rep")
        .applyInPandas(mean, "rep int, mean double")
        .agg(F.avg("mean").alias("mean_distance"))
    )
