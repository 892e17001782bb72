"""Reports over cluster assignments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.corpus import zip_by_position


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    """(cluster_id, n) in cluster order."""
    return assignments.groupBy("cluster_id").agg(F.count("*").alias("n")).orderBy("cluster_id")


def cluster_ids(assignments: DataFrame) -> DataFrame:
    """Distinct cluster ids in order; noise (-1) is one of them."""
    return assignments.select("cluster_id").distinct().orderBy("cluster_id")


def n_clusters(assignments: DataFrame) -> DataFrame:
    """Number of distinct cluster ids as one row."""
    return assignments.agg(F.count_distinct("cluster_id").alias("n_clusters"))


def cluster_report(
    vectors: DataFrame,
    predictions: DataFrame,
    vector_order: Sequence[str],
    prediction_order: Sequence[str],
) -> DataFrame:
    """(position, x, y, prediction): two coordinates of each vector next to its prediction.

    For files that carry no id; the rows are matched by position. The coordinates are the
    second and third component of the vector.
    """
    points = vectors.withColumn("x", F.get("vec", F.lit(1))).withColumn("y", F.get("vec", F.lit(2)))
    zipped = zip_by_position(
        points.select("x", "y", *vector_order),
        predictions.select(
            "prediction", *[F.col(c).alias(f"_p_{c}") for c in prediction_order]
        ),
        vector_order,
        [f"_p_{c}" for c in prediction_order],
    )
    return zipped.select("position", "x", "y", "prediction")
