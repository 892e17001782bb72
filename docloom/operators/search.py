"""Cluster search: the clusters whose tags are most similar to a query."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.functions.vector import cosine
from docloom.operators import blocks
from docloom.runtime import MODEL_BYTES


def parse_taggings(lines: DataFrame, value: str = "value", line: str = "line") -> DataFrame:
    """Lines ``<int> tag1, tag2`` to (tag, cluster_id, line, position).

    Trailing spaces go; a line whose head is not an integer, and empty tags, are skipped.
    """
    text = F.regexp_replace(F.col(value), r"\n$", "")
    text = F.regexp_replace(text, " +$", "")
    head = F.regexp_extract(text, r"^([+-]?[0-9]+)( |, |$)", 1)
    tags = F.split(F.regexp_replace(text, r"^[+-]?[0-9]+ ?", ""), ", ", -1)
    return (
        lines.withColumn("cluster_id", head.try_cast("int"))
        .where(F.col("cluster_id").isNotNull())
        .select(F.posexplode(tags).alias("position", "tag"), "cluster_id", line)
        .where(F.col("tag") != "")
        .select("tag", "cluster_id", line, "position")
    )


def dedupe_tags(tags: DataFrame, order: Sequence[str] = ("line", "position")) -> DataFrame:
    """A tag given to several clusters belongs to the last one in ``order``: (tag, cluster_id)."""
    return tags.groupBy("tag").agg(F.max_by("cluster_id", F.struct(*order)).alias("cluster_id"))


def _floored(scored: DataFrame, *keys: str) -> DataFrame:
    return scored.groupBy(*keys, "cluster_id").agg(
        F.greatest(F.max("score"), F.lit(0.0)).alias("score")
    )


def search(query: Column, tags: DataFrame, n: int = 5) -> DataFrame:
    """(cluster_id, score) for one query vector over (tag, cluster_id, vec).

    The ``n`` best tags count, together with all that tie with the n-th; a cluster scores
    its best tag, at least 0. Scores that agree to nine decimals tie. Only the n best
    scores visit the driver.
    """
    scored = tags.select("cluster_id", F.round(cosine(F.col("vec"), query), 9).alias("score"))
    best = scored.select("score").orderBy(F.desc("score")).limit(n).collect()
    floor = best[-1]["score"] if best else 0.0
    return _floored(scored.where(F.col("score") >= F.lit(floor)))


def search_batch(
    queries: DataFrame,
    tags: DataFrame,
    n: int = 5,
    model_bytes: int = MODEL_BYTES,
    block_rows: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """(query_id, cluster_id, score) for many queries (query_id, vec) over (cluster_id, vec).

    The tag table is measured. While it fits ``model_bytes`` it is broadcast and queries are
    not shuffled; otherwise tag blocks meet query blocks, and the local best are ranked again.
    Scores that agree to nine decimals tie.
    """
    size = tags.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("d")
    ).first()
    if size["n"] * size["d"] * 8 <= model_bytes:
        rows = tags.select("cluster_id", "vec").toPandas()
        if rows.empty:
            return queries.sparkSession.createDataFrame(
                [], "query_id long, cluster_id int, score double"
            )
        state = queries.sparkSession.sparkContext.broadcast(
            (
                rows["cluster_id"].to_numpy(np.int32),
                kernels.unit_rows(kernels.stack(rows["vec"])),
            )
        )

        @F.pandas_udf("array<struct<cluster_id:int,score:double>>")
        def best(vec: pd.Series) -> pd.Series:
            clusters, matrix = state.value
            out = [[] for _ in range(len(vec))]
            units = kernels.unit_rows(kernels.stack(vec))
            for row, found, scores in kernels.best_scores(units, matrix, n):
                out[row] = [
                    {"cluster_id": int(clusters[t]), "score": float(s)} for t, s in zip(found, scores)
                ]
            return pd.Series(out)

        hits = queries.select("query_id", F.explode(best("vec")).alias("_h")).select(
            "query_id", "_h.cluster_id", "_h.score"
        )
        return _floored(hits, "query_id")

    def kernel(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        ids, clusters, scores = [], [], []
        names = t["cluster_id"].to_numpy(np.int32)
        matrix = kernels.unit_rows(kernels.stack(t["vec"]))
        units = kernels.unit_rows(kernels.stack(q["vec"]))
        for row, found, values in kernels.best_scores(units, matrix, n):
            ids.append(np.full(len(found), q["id"].iloc[row]))
            clusters.append(names[found])
            scores.append(values)
        return pd.DataFrame(
            {
                "query_id": np.concatenate(ids),
                "cluster_id": np.concatenate(clusters),
                "score": np.concatenate(scores),
            }
        )

    local = blocks.rectangle(
        queries.select(F.col("query_id").alias("id"), "vec"),
        tags.select(F.xxhash64("cluster_id", "vec").alias("id"), "cluster_id", "vec"),
        kernel,
        "query_id long, cluster_id int, score double",
        queries.count(),
        size["n"],
        block_rows,
    )
    place = Window.partitionBy("query_id").orderBy(F.desc("score"))
    top = local.withColumn("_r", F.rank().over(place)).where(F.col("_r") <= n)
    return _floored(top, "query_id")
