"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.runtime import forget, materialize


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node either has exactly one smaller neighbour or is one, never both."""
    ends = edges.select(F.col("big").alias("n"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("small").alias("n"), F.lit(0).alias("up"))
    )
    ups, all_ends = F.sum("up"), F.count("*")
    mixed = (ups > 1) | ((ups == 1) & (all_ends > 1))
    return ends.groupBy("n").agg(mixed.alias("mixed")).where("mixed").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) edges to (node, root), root being the smallest node of the component.

    Every round is two minimum-aggregations (combined map-side, so a node with a huge
    neighbourhood is cheap) and two equi-joins against one row per node, which AQE splits
    when a node is hot. Each round is written to the shared folder to cut the lineage, and the
    round before it is deleted. The rounds go on until the components are stars: their number
    grows with the logarithm of the longest path.
    """
    current = materialize(
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("big"), F.least("src", "dst").alias("small"))
        .distinct(),
        "edges",
    )
    while not _is_star_forest(current):
        both = current.select(F.col("big").alias("u"), F.col("small").alias("v")).unionByName(
            current.select(F.col("small").alias("u"), F.col("big").alias("v"))
        )
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(lowest, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("big"), F.col("m").alias("small"))
            .distinct()
        )
        floor = large.groupBy("big").agg(F.min("small").alias("m"))
        small = (
            large.join(floor, "big")
            .where(F.col("small") != F.col("m"))
            .select(F.col("small").alias("big"), F.col("m").alias("small"))
            .unionByName(floor.select("big", F.col("m").alias("small")))
            .distinct()
        )
        before, current = current, materialize(small, "edges")
        forget(before)
    roots = current.select(F.col("small").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("big").alias("node"), F.col("small").alias("root")).unionByName(roots)
