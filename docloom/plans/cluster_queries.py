"""Clustering, distances, density and maps over the embedding table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.operators import assign, cluster, density, density_forest, many_kmeans, mixture, report, som
from docloom.plans import sql
from docloom.plans.corpus_queries import _SAMPLE
from docloom.plans.feature_queries import vectors
from docloom.plans.registry import query
from docloom.plans.text_queries import tokens

EPS, MIN_SAMPLES = 1.15, 3


def points(spark, folder):
    return vectors(spark, folder).select("doc_id", "vec")


def label_means(spark, folder):
    """The mean vector of every label: centres that depend on the whole table."""
    return cluster.mean_centres(vectors(spark, folder))


def _codebook(spark, folder):
    rows = label_means(spark, folder).orderBy("cluster_id").collect()
    return kernels.stack(pd.Series([row["vec"] for row in rows]))


@query("assign_nearest", f"""WITH {sql.VECTORS}, {sql.ASSIGNED}
  SELECT doc_id, cluster_id, round(d2, 6) AS distance2 FROM assigned""")
def assign_nearest(spark, folder):
    found = assign.assign_nearest(points(spark, folder), label_means(spark, folder))
    return found.select("doc_id", "cluster_id", F.round("distance2", 6).alias("distance2"))


@query("lloyd_step", f"""WITH {sql.VECTORS}, {sql.ASSIGNED},
  moved AS (SELECT cluster_id, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS i FROM assigned)
  SELECT cluster_id, CAST(i AS INTEGER) AS i, round(avg(x), 6) + 0.0 AS x, count(*) AS n FROM moved GROUP BY ALL""")
def lloyd_step(spark, folder):
    moved = assign.lloyd_step(points(spark, folder), label_means(spark, folder))
    return moved.select("cluster_id", F.posexplode("vec").alias("i", "x"), "n").withColumn(
        "x", F.round("x", 6) + 0.0
    )


@query("wss", f"WITH {sql.VECTORS}, {sql.ASSIGNED} SELECT round(sum(d2), 6) AS wss FROM assigned")
def wss(spark, folder):
    found = assign.assign_nearest(points(spark, folder), label_means(spark, folder))
    return assign.wss(found).select(F.round("wss", 6).alias("wss"))


_LABELLED = "labelled AS (SELECT 0 AS k, doc_id, vec, cluster_id FROM v)"


@query("silhouette", f"""WITH {sql.VECTORS}, {_LABELLED}, {sql.silhouette('labelled', 2)}
  SELECT round(silhouette, 6) AS silhouette FROM sil""")
def silhouette(spark, folder):
    value = cluster.silhouette(vectors(spark, folder))
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


@query("silhouette_exact", f"""WITH {sql.VECTORS}, {_LABELLED}, {sql.silhouette('labelled', 1)}
  SELECT round(silhouette, 6) AS silhouette, (SELECT count(DISTINCT cluster_id) FROM v) AS clusters FROM sil""")
def silhouette_exact(spark, folder):
    return density.silhouette_exact(vectors(spark, folder)).withColumn("silhouette", F.round("silhouette", 6))


_KS = (4, 6, 8, 10)


@query("best_k", f"""WITH {sql.VECTORS},
  ks(k) AS (VALUES {', '.join(f'({k})' for k in _KS)}),
  near AS (SELECT k, doc_id, vec, c AS cluster_id FROM ks JOIN centre ON c < k CROSS JOIN v
           QUALIFY row_number() OVER (PARTITION BY k, doc_id ORDER BY list_distance(vec, cvec), c) = 1),
  {sql.silhouette('near', 2)}
  SELECT k, round(silhouette, 6) AS silhouette FROM sil ORDER BY sil.silhouette DESC, k LIMIT 1""")
def best_k(spark, folder):
    centres = label_means(spark, folder)
    sweep = cluster.score_centres(points(spark, folder), {k: centres.where(F.col("cluster_id") < k) for k in _KS})
    return cluster.best_k(sweep).withColumn("silhouette", F.round("silhouette", 6))


@query("kmeans")
def kmeans(spark, folder):
    return cluster.kmeans(points(spark, folder), k=100).assignments


@query("kmeans_sweep")
def kmeans_sweep(spark, folder):
    return many_kmeans.kmeans_sweep(points(spark, folder)).drop("seconds")


@query("bisecting_kmeans")
def bisecting_kmeans(spark, folder):
    return cluster.bisecting_kmeans(points(spark, folder), k=50).assignments


@query("gmm")
def gmm(spark, folder):
    return mixture.gmm(points(spark, folder)).assignments.select("doc_id", "cluster_id")


@query("gmm_sweep")
def gmm_sweep(spark, folder):
    return mixture.gmm_sweep(points(spark, folder)).drop("seconds")


PRIOR = 64


@query("gmm_m_step", f"""WITH {sql.VECTORS},
  total AS (SELECT count(*) AS n FROM v),
  size AS (SELECT cluster_id, count(*) AS n FROM v GROUP BY ALL),
  cross_ AS (SELECT a.doc_id, a.cluster_id, a.i, b.i AS j, a.x AS x, b.x AS y FROM cell a JOIN cell b USING (doc_id)),
  pooled AS (SELECT i, j, covar_pop(x, y) AS c FROM cross_ GROUP BY i, j),
  own AS (SELECT cluster_id, i, j, covar_pop(x, y) AS c FROM cross_ GROUP BY ALL)
  SELECT cluster_id, round(size.n / total.n, 8) AS weight, CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j,
         round((size.n * own.c + {PRIOR} * pooled.c) / (size.n + {PRIOR}), 8) + 0.0 AS cov
  FROM own JOIN pooled USING (i, j) JOIN size USING (cluster_id) CROSS JOIN total""")
def gmm_m_step(spark, folder):
    stepped = mixture.m_step(vectors(spark, folder), float(PRIOR))
    return stepped.withColumns({"weight": F.round("weight", 8), "cov": F.round("cov", 8) + 0.0})


@query("lda_cluster")
def lda_cluster(spark, folder):
    return cluster.lda(tokens(spark, folder)).assignments.select("doc_id", "cluster_id")


@query("lda_sweep")
def lda_sweep(spark, folder):
    return cluster.lda_sweep(tokens(spark, folder), (10, 20))


@query("epsilon_join", f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings)
  SELECT a.id AS id_a, b.id AS id_b, round(list_distance(a.vec, b.vec), 6) AS distance
  FROM v a JOIN v b ON a.id < b.id WHERE list_distance(a.vec, b.vec) <= {EPS}""")
def epsilon_join(spark, folder):
    return density.epsilon_join(points(spark, folder), EPS).withColumn("distance", F.round("distance", 6))


@query("dbscan", f"""WITH RECURSIVE
  v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
  near AS (SELECT a.id, b.id AS other FROM v a JOIN v b ON list_distance(a.vec, b.vec) <= {EPS}),
  core AS (SELECT id FROM near GROUP BY id HAVING count(*) >= {MIN_SAMPLES}),
  edge AS (SELECT id, other FROM near WHERE id IN (FROM core) AND other IN (FROM core)),
  reach(id, root) AS (SELECT id, id FROM core
                      UNION SELECT e.other, r.root FROM reach r JOIN edge e ON e.id = r.id WHERE r.root < e.other),
  root AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
  numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM root),
  border AS (SELECT near.id, min(cluster_id) AS cluster_id FROM near JOIN numbered ON numbered.id = near.other
             GROUP BY near.id)
  SELECT v.id AS doc_id, CAST(coalesce(numbered.cluster_id, border.cluster_id, -1) AS INTEGER) AS cluster_id
  FROM v LEFT JOIN numbered ON numbered.id = v.id LEFT JOIN border ON border.id = v.id""")
def dbscan(spark, folder):
    return density.dbscan(points(spark, folder), EPS, MIN_SAMPLES)


SWEEP = (1.06, 1.08, 1.1, 1.12, 1.14, 1.16, 1.18, 1.2)

# DBSCAN at every radius of the sweep: labelled (k = radius, doc_id, vec, cluster_id)
_SWEPT = f"""
  v AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS vec FROM embeddings),
  pair AS (SELECT a.doc_id AS id, b.doc_id AS other, list_distance(a.vec, b.vec) AS d FROM v a JOIN v b
           ON list_distance(a.vec, b.vec) <= {max(SWEEP)}),
  eps(k) AS (VALUES {', '.join(f'({e}::DOUBLE)' for e in SWEEP)}),
  near AS (SELECT k, id, other FROM eps JOIN pair ON d <= k),
  core AS (SELECT k, id FROM near GROUP BY k, id HAVING count(*) >= {MIN_SAMPLES}),
  edge AS (SELECT n.k, n.id, n.other FROM near n JOIN core a ON a.k = n.k AND a.id = n.id JOIN core b ON b.k = n.k AND b.id = n.other),
  reach(k, id, root) AS (SELECT k, id, id FROM core
                         UNION SELECT r.k, e.other, r.root FROM reach r JOIN edge e ON e.k = r.k AND e.id = r.id WHERE r.root < e.other),
  root AS (SELECT k, id, min(root) AS root FROM reach GROUP BY k, id),
  numbered AS (SELECT k, id, dense_rank() OVER (PARTITION BY k ORDER BY root) - 1 AS cluster_id FROM root),
  border AS (SELECT n.k, n.id, min(cluster_id) AS cluster_id FROM near n JOIN numbered m ON m.k = n.k AND m.id = n.other GROUP BY n.k, n.id),
  labelled AS (SELECT eps.k, v.doc_id, v.vec, CAST(coalesce(m.cluster_id, b.cluster_id, -1) AS INTEGER) AS cluster_id
               FROM v CROSS JOIN eps LEFT JOIN numbered m ON m.k = eps.k AND m.id = v.doc_id
               LEFT JOIN border b ON b.k = eps.k AND b.id = v.doc_id)"""


@query("dbscan_levels", f"WITH RECURSIVE {_SWEPT} SELECT doc_id, k AS eps, cluster_id FROM labelled")
def dbscan_levels(spark, folder):
    rows = points(spark, folder)
    return density_forest.dbscan_at(rows, density_forest.density_forest(rows, SWEEP, MIN_SAMPLES))


@query("dbscan_sweep", f"""WITH RECURSIVE {_SWEPT}, {sql.silhouette('labelled', 1)},
  counted AS (SELECT k, count(DISTINCT cluster_id) AS n FROM labelled GROUP BY k),
  scored AS (SELECT k, n, CASE WHEN n > 1 THEN silhouette END AS s FROM counted JOIN sil USING (k))
  SELECT k AS eps, n AS n_clusters, round(s, 6) AS silhouette,
         s IS NOT NULL AND row_number() OVER (ORDER BY s DESC NULLS LAST, k) = 1 AS best FROM scored""")
def dbscan_sweep(spark, folder):
    swept = density_forest.dbscan_sweep(points(spark, folder), SWEEP, MIN_SAMPLES)
    return swept.select("eps", "n_clusters", F.round("silhouette", 6).alias("silhouette"), "best")


@query("pairwise_mean_distance", """WITH v AS (SELECT embedding::DOUBLE[] AS vec FROM embeddings)
  SELECT round(avg(list_distance(a.vec, b.vec)), 6) AS mean_distance FROM v a CROSS JOIN v b""")
def pairwise_mean_distance(spark, folder):
    return density.pairwise_mean_distance(points(spark, folder)).select(
        F.round("mean_distance", 6).alias("mean_distance")
    )


@query("sampled_mean_distance", f"""WITH {_SAMPLE},
  per_rep AS (SELECT a.rep, avg(list_distance(a.vec, b.vec)) AS mean FROM picked a JOIN picked b USING (rep) GROUP BY a.rep)
  SELECT round(avg(mean), 6) AS mean_distance FROM per_rep""")
def sampled_mean_distance(spark, folder):
    return density.sampled_mean_distance(points(spark, folder), 100, 10, 7).select(
        F.round("mean_distance", 6).alias("mean_distance")
    )


@query("som")
def som_fit(spark, folder):
    return som.som(points(spark, folder), 10, 10).assignments


@query("som_history")
def som_history(spark, folder):
    history = som.som(points(spark, folder), 10, 10).history
    return spark.createDataFrame(list(enumerate(history)), "iteration int, cost double")


@query("som_assign", f"WITH {sql.VECTORS}, {sql.ASSIGNED} SELECT doc_id, cluster_id FROM assigned")
def som_assign(spark, folder):
    return som.som_assign(points(spark, folder), _codebook(spark, folder)).select("doc_id", "cluster_id")


@query("som_step", f"""WITH {sql.VECTORS}, {sql.ASSIGNED},
  unit AS (SELECT c, c // 5 AS r, c % 5 AS q FROM centre),
  part AS (SELECT cluster_id AS c, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS i FROM assigned),
  sums AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM part GROUP BY ALL),
  pull AS (SELECT a.c AS unit, i, exp(-(power(a.r - b.r, 2) + power(a.q - b.q, 2)) / 2.0) AS w, s, n
           FROM unit a CROSS JOIN unit b JOIN sums ON sums.c = b.c)
  SELECT unit, CAST(i AS INTEGER) AS i, round(sum(w * s) / sum(w * n), 6) + 0.0 AS x FROM pull GROUP BY unit, i""")
def som_step(spark, folder):
    moved, _ = som.som_step(points(spark, folder), _codebook(spark, folder), 2, 5, 1.0)
    rows = [(unit, [float(x) for x in vec]) for unit, vec in enumerate(moved)]
    return (
        spark.createDataFrame(rows, "unit int, vec array<double>")
        .select("unit", F.posexplode("vec").alias("i", "x"))
        .withColumn("x", F.round("x", 6) + 0.0)
    )


@query("cluster_sizes", "SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY label ORDER BY label")
def cluster_sizes(spark, folder):
    return report.cluster_sizes(vectors(spark, folder))


@query("cluster_ids", "SELECT DISTINCT label AS cluster_id FROM embeddings")
def cluster_ids(spark, folder):
    return report.cluster_ids(vectors(spark, folder))


@query("n_clusters", "SELECT count(DISTINCT label) AS n_clusters FROM embeddings")
def n_clusters(spark, folder):
    return report.n_clusters(vectors(spark, folder))


@query("cluster_report", """
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, round(embedding[2]::DOUBLE, 6) AS x,
         round(embedding[3]::DOUBLE, 6) AS y, label AS prediction FROM embeddings""")
def cluster_report(spark, folder):
    v = vectors(spark, folder)
    predictions = v.select(F.col("cluster_id").alias("prediction"), "doc_id")
    zipped = report.cluster_report(v.select("vec", "doc_id"), predictions, ["doc_id"], ["doc_id"])
    return zipped.select("position", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "prediction")
