"""Joins, filters, aggregates, positions and samples over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import corpus
from docloom.plans import sql
from docloom.plans.registry import query, table


@query("project_columns", """
  SELECT doc_id AS paper_id, lang AS language, n_chars + 1 AS n_more, source FROM documents""")
def project_columns(spark, folder):
    return (
        table(spark, folder, "documents")
        .withColumnsRenamed({"doc_id": "paper_id", "lang": "language"})
        .withColumn("n_more", F.col("n_chars") + 1)
        .drop("n_chars", "text")
    )


@query("join_metadata", """
  WITH first AS (SELECT conv_id, role, text FROM conversations
                 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)
  SELECT d.doc_id, d.lang, f.role, f.text AS title FROM documents d JOIN first f ON d.doc_id = f.conv_id""")
def join_metadata(spark, folder):
    metadata = table(spark, folder, "conversations").withColumnRenamed("text", "title")
    papers = table(spark, folder, "documents").select("doc_id", "lang")
    return corpus.join_metadata(papers, metadata, "doc_id", "conv_id", "turn")


@query("dedupe_docs", """
  SELECT doc_id, lang, n_chars FROM documents
  QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""")
def dedupe_docs(spark, folder):
    return corpus.dedupe(table(spark, folder, "documents"), ["text", "lang"], "doc_id").select(
        "doc_id", "lang", "n_chars"
    )


@query("drop_incomplete", """
  SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
  WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def drop_incomplete(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return corpus.drop_incomplete(docs.join(table(spark, folder, "labels"), "doc_id", "left"))


@query("filter_language", "SELECT doc_id, lang, text FROM documents WHERE lang = 'en'")
def filter_language(spark, folder):
    return corpus.filter_language(
        table(spark, folder, "documents").select("doc_id", "lang", "text"), "en", "lang"
    )


@query("language_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def language_counts(spark, folder):
    return corpus.language_counts(table(spark, folder, "documents"), "lang")


def _describe_sql(column: str) -> str:
    return f"""
  SELECT '{column}' AS "column", CAST(sum(c) AS BIGINT) AS "count", count(*) AS "unique",
         arg_min(value, {{'a': -c, 'b': first}}) AS top, max(c) AS freq
  FROM (SELECT {column} AS value, count(*) AS c, min(doc_id) AS first FROM documents
        WHERE {column} IS NOT NULL GROUP BY {column})"""


@query("describe_text", " UNION ALL ".join(_describe_sql(c) for c in ("text", "lang", "source")))
def describe_text(spark, folder):
    return corpus.describe_text(table(spark, folder, "documents"), ["text", "lang", "source"], "doc_id")


@query("row_id", "SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS row_id FROM documents")
def row_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return corpus.with_row_id(docs, ["source", "doc_id"]).select("doc_id", "row_id")


@query("zip_by_position", """
  WITH a AS (SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS position FROM documents),
  b AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS position FROM conversations)
  SELECT position, doc_id, lang, conv_id, turn FROM a JOIN b USING (position)""")
def zip_by_position(spark, folder):
    return corpus.zip_by_position(
        table(spark, folder, "documents").select("doc_id", "lang"),
        table(spark, folder, "conversations").select("conv_id", "turn"),
        ["lang", "doc_id"],
        ["conv_id", "turn"],
    )


@query("union_parts", """
  SELECT doc_id AS id, text FROM documents UNION ALL SELECT conv_id, text FROM conversations
  UNION ALL SELECT item_id, text FROM benchmark""")
def union_parts(spark, folder):
    names = {"documents": "doc_id", "conversations": "conv_id", "benchmark": "item_id"}
    return corpus.union_parts(
        *[table(spark, folder, t).select(F.col(c).alias("id"), "text") for t, c in names.items()]
    )


@query("sample_docs", f"""
  SELECT doc_id, lang FROM documents
  WHERE {sql.md5_number('doc_id', '7')} < {int(0.1 * 2**32)}""")
def sample_docs(spark, folder):
    return corpus.sample_docs(table(spark, folder, "documents").select("doc_id", "lang"), 0.1, 7)


_SAMPLE = f"""
  draws AS (SELECT vec_id AS doc_id, CAST(r.rep AS INTEGER) AS rep, embedding::DOUBLE[] AS vec,
                   {sql.md5_number('vec_id', 'r.rep', '7')} AS draw
            FROM embeddings, range(10) r(rep)),
  picked AS (SELECT rep, doc_id, vec FROM draws
             QUALIFY row_number() OVER (PARTITION BY rep ORDER BY draw, doc_id) <= 100)"""


@query("sample_n", f"WITH {_SAMPLE} SELECT rep, doc_id FROM picked")
def sample_n(spark, folder):
    ids = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return corpus.sample_n(ids, 100, 10, 7)
