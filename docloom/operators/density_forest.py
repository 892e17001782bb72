"""DBSCAN at many radii from one pass over the neighbours.

At radius eps two core points are in one cluster when a chain of core points joins them with steps of at
most eps. A step is possible from the radius max(core distance of either end, distance) on, so
the clusters of every radius are cuts of one spanning forest over these weights. With the radii of a sweep
given, a weight is the place of the smallest radius that reaches it (its level).

1. A counting pass over the neighbour blocks gives each point its neighbours within each radius, hence the
   level from which it is a core point.
2. A second pass gives each block's minimum spanning forest (at most one row per point and block) and,
   for points that are not core yet, the core points in reach: fewer than ``min_samples`` for each.
3. The block forests are merged level by level. An edge is used once, at its own level, between the clusters
   of the level before, so the component search works on what that level adds.
4. Silhouettes of all radii come from one pass over the distances.

Distances are computed twice for all radii, and once more for silhouettes, instead of three times for each radius.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.operators import blocks
from docloom.operators.components import connected_components
from docloom.operators.corpus import number_within
from docloom.runtime import forget, materialize, timed


@dataclass
class DensityForest:
    """The clusters of every radius.

    ``points``: (id, vec, w, core): distinct vectors with the level from which they are core points (the number of radii if
    never). ``clusters``: (id, level, cluster_id) of core and border points; what is missing is noise.
    """

    eps: list[float]
    points: DataFrame
    clusters: DataFrame


def density_forest(
    df: DataFrame,
    eps_values: Sequence[float],
    min_samples: int | None = None,
    anchors: int | None = None,
    block_rows: int | None = None,
) -> DensityForest:
    """Clusters of (doc_id, vec) at each radius, by the rules and the numbering of ``density.dbscan``."""
    eps = sorted({float(e) for e in eps_values})
    if not eps:
        raise ValueError("a sweep needs at least one radius")
    if min_samples is None:
        min_samples = 2 * df.select(F.size("vec").alias("d")).first()["d"] - 1
    limits, never = np.array(eps), len(eps)
    merged = materialize(df.groupBy("vec").agg(F.min("doc_id").alias("id"), F.count("*").alias("w")), "merged")
    rows = merged.count()
    placed = blocks.anchored(merged, eps[-1], rows, anchors)
    if blocks.anchor_count(rows, anchors) > 1:
        placed = materialize(placed, "anchored")
    sizes = blocks.anchor_blocks(placed, rows, anchors, block_rows)

    def count_kernel(homes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        _, _, pieces = kernels.level_pairs(homes, members, limits)
        weight_l, weight_r = homes["w"].to_numpy(float), members["w"].to_numpy(float)
        seen_l, seen_r = np.zeros(len(homes) * never), np.zeros(len(members) * never)
        for i, j, level in pieces:
            seen_l += np.bincount(i * never + level, weight_r[j], minlength=len(seen_l))
            seen_r += np.bincount(j * never + level, weight_l[i], minlength=len(seen_r))
        seen = np.concatenate([seen_l, seen_r]).reshape(-1, never).cumsum(axis=1).astype(np.int64)
        met = seen[:, -1] > 0
        ids = np.concatenate([homes["id"], members["id"]])[met]
        return pd.DataFrame({"id": ids} | {f"s{k}": seen[met, k] for k in range(never)})

    names = [f"s{k}" for k in range(never)]
    counts = blocks.neighbour_groups(placed, sizes, count_kernel, ", ".join(["id long", *(f"{n} long" for n in names)]))
    counts = counts.groupBy("id").agg(*[F.sum(n).alias(n) for n in names])
    core = F.lit(never)
    for k in reversed(range(never)):
        core = F.when(F.col("w") + F.coalesce(names[k], F.lit(0)) >= min_samples, F.lit(k)).otherwise(core)
    points = materialize(placed.join(counts, "id", "left").withColumn("core", core).drop(*names), "points")

    def edge_kernel(homes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        _, _, pieces = kernels.level_pairs(homes, members, limits)
        left, right = homes["id"].to_numpy(), members["id"].to_numpy()
        core_l, core_r = homes["core"].to_numpy(), members["core"].to_numpy()
        links, border = kernels.LevelLinks(left, right, never), []
        for i, j, level in pieces:
            to_right, to_left = np.maximum(level, core_r[j]), np.maximum(level, core_l[i])
            links.join(i, j, np.maximum(to_right, to_left))
            k, m = np.flatnonzero(to_right < core_l[i]), np.flatnonzero(to_left < core_r[j])
            border.append((left[i[k]], right[j[k]], to_right[k], core_l[i[k]] - 1))
            border.append((right[j[m]], left[i[m]], to_left[m], core_r[j[m]] - 1))
        node, root, at = links.forest()
        border.append((node, root, at, np.full(len(node), -1)))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("a", "b", "level", "until"), zip(*border))})

    edges = blocks.neighbour_groups(points, sizes, edge_kernel, "a long, b long, level int, until int")
    edges = materialize(edges, "forest-edges")
    roots = _cut_levels(points, edges.where("until < 0"), never)
    clusters = number_within(roots.select("level", "root").distinct(), "level", ["root"], "cluster_id")
    inside = materialize(roots.join(clusters, ["level", "root"]).select("id", "level", "cluster_id"), "inside")
    border = edges.where("until >= 0").select("a", "b", F.explode(F.sequence("level", "until")).alias("level"))
    reached = border.join(inside.withColumnRenamed("id", "b"), ["b", "level"])
    reached = reached.groupBy(F.col("a").alias("id"), "level").agg(F.min("cluster_id").alias("cluster_id"))
    return DensityForest(eps, points.select("id", "vec", "w", "core"), materialize(inside.unionByName(reached), "clusters"))


def _cut_levels(points: DataFrame, edges: DataFrame, levels: int) -> DataFrame:
    """(id, level, root): the smallest core point of each core point's cluster, level by level."""
    cuts, before = [], points.where("core < 0").select("id", F.col("id").alias("root"))
    names = before.withColumnsRenamed({"id": "node", "root": "up"})
    for level in range(levels):
        own = edges.where(F.col("level") == level)
        fresh = points.where(F.col("core") == level).select("id", F.col("id").alias("root"))
        now = before.unionByName(fresh)
        if not own.isEmpty():
            for side in ("a", "b"):
                own = own.join(names, own[side] == names["node"], "left").withColumn(side, F.coalesce("up", side)).drop("node", "up")
            joined = connected_components(own.select(F.col("a").alias("src"), F.col("b").alias("dst")))
            joined = joined.select(F.col("root").alias("up"), F.col("node").alias("root"))
            now = now.join(joined, "root", "left").select("id", F.coalesce("up", "root").alias("root"))
        before = materialize(now, "cut")
        names = before.withColumnsRenamed({"id": "node", "root": "up"})
        cuts.append(before.withColumn("level", F.lit(level)))
    every = cuts[0]
    for cut in cuts[1:]:
        every = every.unionByName(cut)
    return every


def labels(df: DataFrame, forest: DensityForest) -> DataFrame:
    """(doc_id, vec, labels): the cluster at each radius, in their order; -1 is noise."""
    known = forest.clusters.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("level", "cluster_id"))).alias("of"))
    levels = F.sequence(F.lit(0), F.lit(len(forest.eps) - 1))
    found = F.transform(levels, lambda k: F.coalesce(F.try_element_at("of", k), F.lit(-1)).cast("int"))
    none = F.transform(levels, lambda _: F.lit(-1))
    labelled = forest.points.join(known, "id", "left").select("vec", F.when(F.col("of").isNull(), none).otherwise(found).alias("labels"))
    # copies take the labels of their vector; AQE splits a vector that is hot
    return df.select("doc_id", "vec").join(labelled, "vec")


def dbscan_at(df: DataFrame, forest: DensityForest) -> DataFrame:
    """(doc_id, eps, cluster_id): one row for each document and radius."""
    rows = labels(df, forest).select("doc_id", F.posexplode("labels").alias("level", "cluster_id"))
    return rows.select("doc_id", F.element_at(F.lit(forest.eps), F.col("level") + 1).alias("eps"), "cluster_id")


def silhouettes(labelled: DataFrame, block_rows: int | None = None) -> DataFrame:
    """(level, silhouette, clusters) of (doc_id, vec, labels) with one label per level: Euclidean, exact.

    Noise counts as a cluster; null with fewer than two clusters. Quadratic by definition; the distances of a
    pair of blocks serve all levels, and only sums per point and cluster leave it.
    """
    rows = labelled.select(F.col("doc_id").alias("id"), "vec", "labels")

    def grouped(side: pd.DataFrame):
        """A side in the order of its groups, rows of equal labels: (rows, matrix, labels of rows, of groups, group of each row)."""
        codes, place = np.unique(np.stack(side["labels"].to_numpy()), axis=0, return_inverse=True)
        order = np.argsort(place.ravel(), kind="stable")
        side, place = side.iloc[order], place.ravel()[order]
        return side["id"].to_numpy(), kernels.stack(side["vec"]), codes[place], codes, place

    def sums(ids: np.ndarray, mine: np.ndarray, total: np.ndarray, codes: np.ndarray) -> list[pd.DataFrame]:
        parts = []
        for level in range(codes.shape[1]):
            names, place = np.unique(codes[:, level], return_inverse=True)
            onehot = (place[:, None] == np.arange(len(names))).astype(float)
            columns = {"id": np.repeat(ids, len(names)), "level": level}
            columns |= {"c": np.repeat(mine[:, level], len(names)), "other": np.tile(names, len(ids)), "total": (total @ onehot).ravel()}
            parts.append(pd.DataFrame(columns))
        return parts

    def kernel(low: pd.DataFrame, high: pd.DataFrame | None) -> pd.DataFrame:
        if len(low) == 0 or (high is not None and len(high) == 0):
            return pd.DataFrame({c: [] for c in ("id", "level", "c", "other", "total")})
        ids_a, a, mine_a, codes_a, group_a = grouped(low)
        ids_b, b, mine_b, codes_b, group_b = grouped(low if high is None else high)
        to_b, to_a = kernels.cluster_sums(a, b, group_a, group_b)
        found = sums(ids_a, mine_a, to_b, codes_b)
        return pd.concat(found if high is None else [*found, *sums(ids_b, mine_b, to_a, codes_a)])

    n = rows.count()
    if block_rows is None:
        levels = rows.select(F.posexplode("labels")).distinct().count()
        block_rows = blocks.rows_of_a_block(rows, n, max(levels, rows.select("labels").distinct().count()))
    schema = "id long, level int, c int, other int, total double"
    pairs = blocks.triangle(rows, kernel, schema, n, block_rows)
    per_cluster = pairs.groupBy("id", "level", "c", "other").agg(F.sum("total").alias("total"))
    sizes = rows.select(F.posexplode("labels").alias("level", "other")).groupBy("level", "other").agg(F.count("*").alias("n"))
    own = F.col("c") == F.col("other")
    per_point = (
        per_cluster.join(sizes, ["level", "other"])
        .groupBy("level", "id", "c")
        .agg(
            F.max(F.when(own, F.col("n"))).alias("n"),
            F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
        )
    )
    spread = F.greatest("a", "b")
    score = F.when(F.col("n") == 1, F.lit(0.0)).when(spread > 0, (F.col("b") - F.col("a")) / spread).otherwise(F.lit(0.0))
    clusters = F.count_distinct("c")
    return per_point.groupBy("level").agg(F.when(clusters > 1, F.avg(score)).alias("silhouette"), clusters.alias("clusters"))


def dbscan_sweep(
    df: DataFrame, eps_values: Sequence[float], min_samples: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """(eps, n_clusters, silhouette, best, seconds) per radius; ``n_clusters`` counts noise as a cluster.

    ``best`` marks the highest silhouette, the smaller radius of a tie. The silhouette is null where there is only one
    cluster. ``seconds`` is the time of the one fit that serves all radii.
    """
    vectors = materialize(df.select("doc_id", "vec"), "vectors")
    forest, seconds = timed(lambda: density_forest(vectors, eps_values, min_samples, block_rows=block_rows))
    scores = materialize(silhouettes(labels(vectors, forest), block_rows), "sweep")  # one row per radius
    forget(vectors)
    top = scores.where("silhouette IS NOT NULL").orderBy(F.desc("silhouette"), "level").first()
    best = F.lit(False) if top is None else F.col("level") == top["level"]
    eps = F.element_at(F.lit(forest.eps), F.col("level") + 1)
    return scores.select(
        eps.alias("eps"), F.col("clusters").alias("n_clusters"), "silhouette", best.alias("best"), F.lit(seconds).alias("seconds")
    )
