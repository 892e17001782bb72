"""Term statistics, TF-IDF, PCA and vector functions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions import vector as vx
from docloom.operators import features
from docloom.plans import pipeline, sql
from docloom.plans.registry import query, table
from docloom.plans.text_queries import documents, tokens
from docloom.runtime import materialize

TERMS, MIN_DF = 5000, 5


def stored_tokens(spark, folder):
    """The token table as a written stage: several passes follow."""
    return materialize(tokens(spark, folder), "tokens")


def vocabulary(rows):
    return features.build_vocab(features.term_stats(rows), TERMS, MIN_DF)


@query("term_stats", f"WITH {sql.TOKENS}, {sql.vocab()} SELECT term, tf, df FROM stats")
def term_stats(spark, folder):
    return features.term_stats(tokens(spark, folder))


@query("build_vocab", f"WITH {sql.TOKENS}, {sql.vocab()} SELECT term, term_id, tf, df FROM vocab")
def build_vocab(spark, folder):
    return vocabulary(tokens(spark, folder))


@query("count_vectorize", f"""
  WITH {sql.TOKENS}, {sql.vocab()}
  SELECT doc_id, term, term_id, p.tf FROM postings p JOIN weights USING (term)""")
def count_vectorize(spark, folder):
    rows = stored_tokens(spark, folder)
    return features.count_vectorize(rows, vocabulary(rows), TERMS)


@query("idf_weight", f"""
  WITH {sql.TOKENS}, {sql.vocab()}
  SELECT doc_id, term, p.tf, round(idf, 6) AS idf, round(p.tf * idf, 6) AS weight
  FROM postings p JOIN weights USING (term)""")
def idf_weight(spark, folder):
    rows = stored_tokens(spark, folder)
    weighted = features.idf_weight(rows, vocabulary(rows), rows.count(), TERMS)
    return weighted.select("doc_id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("weight", 6).alias("weight"))


@query("tfidf_l2", rf"""
  WITH runs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS t FROM documents),
  {sql.vocab(4096, 1, 'runs')},
  w AS (SELECT doc_id, term, p.tf * (idf + 1.0) AS w FROM postings p JOIN weights USING (term))
  SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf_l2(spark, folder):
    docs = documents(spark, folder)
    return features.tfidf_l2(docs, docs.count()).withColumn("weight", F.round("weight", 6))


@query("hashing_tf", f"WITH {sql.TOKENS} SELECT doc_id, CAST(len(t) AS DOUBLE) AS tf FROM tokens")
def hashing_tf(spark, folder):
    """Hash places depend on the hash function; their frequencies add up to the number of tokens."""
    hashed = features.hashing_tf(tokens(spark, folder), 4096)
    return hashed.select("doc_id", F.aggregate(vector_to_array("features"), F.lit(0.0), lambda acc, x: acc + x).alias("tf"))


@query("assemble_vectors", """
  SELECT doc_id, CAST(n_chars AS DOUBLE) AS x0, CAST(length(text) AS DOUBLE) AS x1,
         CAST(len(string_split(text, ' ')) AS DOUBLE) AS x2 FROM documents""")
def assemble_vectors(spark, folder):
    rows = documents(spark, folder).select(
        "doc_id", "n_chars", F.char_length("text").alias("chars"), F.size(tx.space_words(F.col("text"))).alias("spaces")
    )
    cells = vector_to_array("features")
    return features.assemble(rows, ["n_chars", "chars", "spaces"]).select(
        "doc_id", *[F.get(cells, F.lit(i)).alias(f"x{i}") for i in range(3)]
    )


def vectors(spark, folder):
    """(doc_id, vec, cluster_id) from the embedding table."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"), vx.doubles(F.col("embedding")).alias("vec"), F.col("label").alias("cluster_id")
    )


@query("covariance", """
  WITH cell AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS i
                FROM embeddings)
  SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.x, b.x), 8) + 0.0 AS cov
  FROM cell a JOIN cell b USING (vec_id) GROUP BY a.i, b.i""")
def covariance(spark, folder):
    return features.covariance(vectors(spark, folder)).withColumn("cov", F.round("cov", 8) + 0.0)


def _long_scores(df):
    return df.select("doc_id", F.posexplode("vec").alias("component", "score"))


@query("pca_project")
def pca_project(spark, folder):
    rows = vectors(spark, folder).select("doc_id", array_to_vector("vec").alias("features"))
    return _long_scores(features.pca_project(rows, 16))


@query("pca_norm", f"""WITH {sql.VECTORS},
  middle AS (SELECT i, avg(x) AS m FROM cell GROUP BY i)
  SELECT doc_id, round(sum(power(x - m, 2)), 6) AS norm2 FROM cell JOIN middle USING (i) GROUP BY doc_id""")
def pca_norm(spark, folder):
    """At full width the centred scores keep every squared distance to the mean."""
    rows = vectors(spark, folder).select("doc_id", array_to_vector("vec").alias("features"))
    width = rows.select("features").first()["features"].size
    norm = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    return features.pca_project(rows, width).select("doc_id", F.round(norm, 6).alias("norm2"))


@query("pca_variance")
def pca_variance(spark, folder):
    rows = vectors(spark, folder).select("doc_id", array_to_vector("vec").alias("features"))
    return _long_scores(features.pca_variance(rows, 0.8)[0])


COMPONENTS = 1325


@query("text_vectors")
def text_vectors(spark, folder):
    """From text to reduced vectors, at the full number of terms and components."""
    return pipeline.text_vectors(documents(spark, folder), COMPONENTS, 4096)[0]


@query("pca_tfidf", rf"""
  WITH runs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS t FROM documents),
  {sql.vocab(4096, 1, 'runs')},
  w AS (SELECT doc_id, term, p.tf * (idf + 1.0) AS w FROM postings p JOIN weights USING (term)),
  unit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w),
  middle AS (SELECT term, sum(w) / (SELECT count(*) FROM documents) AS m FROM unit GROUP BY term)
  SELECT d.doc_id, round(coalesce(own, 0) + (SELECT sum(m * m) FROM middle), 6) AS norm2
  FROM documents d LEFT JOIN (SELECT doc_id, sum(w * w - 2 * w * m) AS own FROM unit JOIN middle USING (term) GROUP BY doc_id) USING (doc_id)""")
def pca_tfidf(spark, folder):
    """Squared lengths of the reduced vectors: whole distances to the mean where there are no more texts than components."""
    norm = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    return text_vectors(spark, folder).select("doc_id", F.round(norm, 6).alias("norm2"))


def _neighbours(spark, folder):
    """Each vector next to the one with the following id."""
    v = vectors(spark, folder)
    shifted = v.select((F.col("doc_id") - 1).alias("doc_id"), F.col("vec").alias("other"))
    return v.join(shifted, "doc_id")


_PAIRS = """WITH v AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS vec FROM embeddings)
  SELECT a.doc_id, round({f}(a.vec, b.vec), 6) AS {name} FROM v a JOIN v b ON b.doc_id = a.doc_id + 1"""


@query("cosine", _PAIRS.format(f="list_cosine_similarity", name="cosine"))
def cosine(spark, folder):
    rows = _neighbours(spark, folder)
    return rows.select("doc_id", F.round(vx.cosine(F.col("vec"), F.col("other")), 6).alias("cosine"))


@query("euclidean", _PAIRS.format(f="list_distance", name="distance"))
def euclidean(spark, folder):
    rows = _neighbours(spark, folder)
    return rows.select("doc_id", F.round(vx.euclidean(F.col("vec"), F.col("other")), 6).alias("distance"))


@query("argmax", """
  SELECT vec_id AS doc_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS position
  FROM embeddings""")
def argmax(spark, folder):
    return vectors(spark, folder).select("doc_id", vx.argmax(F.col("vec")).alias("position"))


@query("format_weights", """
  SELECT vec_id AS doc_id, array_to_string(list_transform(embedding::DOUBLE[], lambda x: printf('%1.4f', x)), ' ')
         AS weights FROM embeddings""")
def format_weights(spark, folder):
    formatted = tx.format_weights(F.col("vec"))
    return vectors(spark, folder).select("doc_id", F.array_join(formatted, " ").alias("weights"))


@query("embed_terms", f"""
  WITH {sql.TOKENS}, {sql.vocab()}
  SELECT term, array_to_string(list_transform({sql.embed('term')}, lambda x: CAST(CAST(x AS INTEGER) AS VARCHAR)), ',') AS vec
  FROM vocab""")
def embed_terms(spark, folder):
    embedded = features.embed_text(F.col("term"))
    return vocabulary(tokens(spark, folder)).select(
        "term", F.array_join(F.transform(embedded, lambda x: x.cast("int").cast("string")), ",").alias("vec")
    )
