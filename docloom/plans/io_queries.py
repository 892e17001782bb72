"""Files: what the writers write, the readers must read back, checked against the tables."""

from __future__ import annotations

from pyspark.sql import functions as F


from docloom.plans.feature_queries import vectors
from docloom.plans.registry import query, table
from docloom.plans.text_queries import documents, sections
from docloom.plans.topic_queries import TAGS, _TOPICS, model
from docloom.runtime import scratch_path
from docloom.sources import readers, writers


@query("read_papers", """
  SELECT CAST(doc_id AS VARCHAR) AS paper_id, source AS abstract, text AS body_text FROM documents WHERE lang <> 'de'""")
def read_papers(spark, folder):
    """Documents as papers, one JSON object per line; German ones lack the abstract."""
    path = scratch_path(spark, "papers")
    abstract = F.array(F.struct(F.col("source").alias("text"), F.lit("Abstract").alias("section")))
    papers = documents(spark, folder).select(
        F.col("doc_id").cast("string").alias("paper_id"),
        F.when(F.col("lang") != "de", abstract).alias("abstract"),
        sections().alias("body_text"),
    )
    papers.write.json(path)
    return readers.read_papers(spark, path, lines=True)[0]


@query("rejected_papers", "SELECT CAST(doc_id AS VARCHAR) AS paper_id FROM documents WHERE lang = 'de'")
def rejected_papers(spark, folder):
    path = scratch_path(spark, "papers")
    documents(spark, folder).select(
        F.col("doc_id").cast("string").alias("paper_id"),
        F.when(F.col("lang") != "de", sections()).alias("abstract"),
        sections().alias("body_text"),
    ).write.json(path)
    return readers.read_papers(spark, path, lines=True)[1].select("paper_id")


@query("read_metadata", """
  SELECT CAST(conv_id AS VARCHAR) AS sha, text AS title, role AS authors, CAST(turn AS VARCHAR) AS doi FROM conversations""")
def read_metadata(spark, folder):
    path = scratch_path(spark, "metadata")
    rows = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("sha"),
        F.col("text").alias("title"),
        F.col("role").alias("authors"),
        F.col("turn").cast("string").alias("doi"),
    )
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_metadata(spark, path).drop("meta_order")


@query("read_vectors", """
  WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS doc_id, embedding::DOUBLE[] AS vec FROM embeddings)
  SELECT doc_id, CAST(unnest(range(0, len(vec))) AS INTEGER) AS i, round(unnest(vec), 9) AS x FROM v""")
def read_vectors(spark, folder):
    """CSV without ids: order alone brings them back."""
    path = scratch_path(spark, "vectors")
    writers.write_vectors(vectors(spark, folder), path, "csv")
    return readers.read_vectors(spark, path).select("doc_id", F.posexplode("vec").alias("i", "x")).withColumn(
        "x", F.round("x", 9)
    )


@query("read_vector_parts", """
  WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS vec, 0 AS part FROM embeddings
             UNION ALL SELECT vec_id, embedding::DOUBLE[], 1 FROM embeddings)
  SELECT row_number() OVER (ORDER BY part, vec_id) - 1 AS doc_id, round(list_sum(vec), 9) + 0.0 AS total FROM v""")
def read_vector_parts(spark, folder):
    """Two parts are one table, in the order they are named."""
    paths = [scratch_path(spark, "vectors") for _ in range(2)]
    for path in paths:
        writers.write_vectors(vectors(spark, folder), path, "csv")
    total = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x)
    return readers.read_vectors(spark, paths).select("doc_id", (F.round(total, 9) + 0.0).alias("total"))


@query("read_vectors_parquet", "SELECT vec_id AS doc_id, len(embedding) AS dim FROM embeddings")
def read_vectors_parquet(spark, folder):
    path = scratch_path(spark, "vectors")
    writers.write_vectors(vectors(spark, folder), path)
    return readers.read_vectors(spark, path, "parquet").select("doc_id", F.size("vec").cast("long").alias("dim"))


_CLUSTERS = "SELECT vec_id AS doc_id, label AS cluster_id FROM embeddings WHERE vec_id % 5 <> 3"


def _with_faults(spark, folder):
    """A cluster file in which every fifth line has a cluster that is no number."""
    path = scratch_path(spark, "clusters")
    v = vectors(spark, folder)
    spoiled = F.when(F.col("doc_id") % 5 == 3, "zz").otherwise(F.col("cluster_id").cast("string"))
    writers.write_clusters(v.select("doc_id", spoiled.alias("cluster_id")), path)
    return readers.read_clusters(spark, path)


@query("read_clusters", _CLUSTERS)
def read_clusters(spark, folder):
    return _with_faults(spark, folder)


@query("count_clusters", f"""WITH c AS ({_CLUSTERS})
  SELECT (SELECT count(*) FROM c) AS n, (SELECT sum(doc_id) FROM c)::BIGINT AS ids""")
def count_clusters(spark, folder):
    """The same rows whichever columns are read."""
    rows = _with_faults(spark, folder)
    ids = rows.select("doc_id").agg(F.sum("doc_id").alias("ids"))
    return rows.agg(F.count("*").alias("n")).withColumn("ids", F.lit(ids.first()["ids"]).cast("long"))


@query("read_predictions", "SELECT label AS prediction, count(*) AS n FROM embeddings GROUP BY label")
def read_predictions(spark, folder):
    path = scratch_path(spark, "predictions")
    vectors(spark, folder).select(F.col("cluster_id").alias("0")).write.option("header", True).csv(path)
    return readers.read_predictions(spark, path).groupBy("prediction").agg(F.count("*").alias("n"))


@query("read_taggings", f"{_TOPICS} SELECT term AS tag, cluster_id, rank - 1 AS position FROM ranked WHERE rank <= {TAGS}")
def read_taggings(spark, folder):
    path = scratch_path(spark, "taggings")
    writers.write_taggings(model(spark, folder).taggings, path)
    return readers.read_taggings(spark, path).select("tag", "cluster_id", "position")


@query("write_search", """SELECT label AS "cluster number", round(max(embedding[1]::DOUBLE), 6) AS score FROM embeddings GROUP BY label""")
def write_search(spark, folder):
    path = scratch_path(spark, "found")
    result = vectors(spark, folder).groupBy("cluster_id").agg(F.max(F.get("vec", F.lit(0))).alias("score"))
    writers.write_search(result, path)
    back = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return back.select(
        F.col("cluster number").cast("int").alias("cluster number"),
        F.round(F.col(" probability").cast("double"), 6).alias("score"),
    )
