"""Writers. Parquet with ids is the native form; the text forms are for exchange."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ordered(df: DataFrame, column: str) -> DataFrame:
    """Globally ordered parts: part files in name order hold increasing keys."""
    return df.repartitionByRange(column).sortWithinPartitions(column)


def write_vectors(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """(doc_id, vec) as parquet, or as headerless CSV lines in id order without the id."""
    if dict(df.dtypes)["vec"] == "vector":
        df = df.withColumn("vec", vector_to_array("vec"))
    if fmt == "parquet":
        df.select("doc_id", "vec").write.parquet(path)
    else:
        lines = F.array_join(F.transform("vec", lambda x: x.cast("string")), ",")
        _ordered(df, "doc_id").select(lines.alias("value")).write.text(path)


def write_clusters(df: DataFrame, path: str) -> None:
    """(doc_id, cluster_id) as CSV with header, id first, in id order (ordered parts)."""
    _ordered(df.select("doc_id", "cluster_id"), "doc_id").write.option("header", True).csv(path)


def write_taggings(tagged: DataFrame, path: str) -> None:
    """(cluster_id, tags) as lines ``<cluster_id> tag1, tag2`` in cluster order."""
    line = F.concat_ws(" ", F.col("cluster_id").cast("string"), F.array_join("tags", ", "))
    _ordered(tagged, "cluster_id").select(line.alias("value")).write.text(path)


def write_search(result: DataFrame, path: str) -> None:
    """(cluster_id, score) as CSV with the header ``cluster number, probability``."""
    (
        result.select(F.col("cluster_id").alias("cluster number"), F.col("score").alias(" probability"))
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
