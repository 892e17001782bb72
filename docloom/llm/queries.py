"""The registered queries of this subpackage: name, function (spark, folder), SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import (
    bpe,
    checks,
    embedding_dedup,
    gru_lm,
    ngram_join,
    packing,
    periodic_runs,
    pii_bootstrap,
    quality_model,
    quality_rules,
    secret_scan,
    spelling,
    url_filter,
    warc,
)
from docloom.llm.common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return add


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def vocabulary() -> str:
    """The tokenizer file of the contracts."""
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_url_ratio")
def op1_url_ratio(spark, folder):
    found = url_filter.filter_urls(_table(spark, folder, "pages", "page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


@query("op2_gru_score")
def op2_gru_score(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text")
    return gru_lm.score_documents(docs, crc_mod(F.col("doc_id"), 7) != 2)


@query("op3_bpe_codec")
def op3_bpe_codec(spark, folder):
    return bpe.digest_round_trip(_table(spark, folder, "documents", "doc_id", "text"), vocabulary())


@query("op4_embedding_dedup", checks.EMBEDDINGS)
def op4_embedding_dedup(spark, folder):
    return embedding_dedup.link_vectors(_table(spark, folder, "embeddings", "vec_id", "embedding"), 0.9)


@query("op5_pattern_packing")
def op5_pattern_packing(spark, folder):
    packed = packing.pack_documents(_table(spark, folder, "documents", "doc_id", "text"), vocabulary(), 4096, 1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query(
    "op6_warc_archive",
    """
    WITH facts AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
            coalesce(html, '') AS payload FROM pages),
    groups AS (SELECT payload, max(page_id) AS keeper FROM facts GROUP BY payload)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
    FROM facts JOIN groups USING (payload)
    """,
)
def op6_warc_archive(spark, folder):
    found = warc.archive_pages(_table(spark, folder, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_ngram_join", checks.ngram_join(4, 85, 100))
def op7_ngram_join(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text")
    return ngram_join.link_components(docs, n=4, num=85, den=100)


def quality_labels(spark, folder):
    """(doc_id, label) of the rows that may be learned from."""
    labels = _table(spark, folder, "labels", "doc_id", "quality").withColumnRenamed("quality", "label")
    return labels.where(crc_mod(F.col("doc_id"), 4) != 2)


@query("op8_quality_model")
def op8_quality_model(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text")
    scored = quality_model.score(docs, quality_model.fit(docs, quality_labels(spark, folder)))
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op9_quality_rules", checks.quality())
def op9_quality_rules(spark, folder):
    judged = quality_rules.judge(_table(spark, folder, "documents", "doc_id", "text", "lang", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op10_secret_scan", checks.secrets(secret_scan.RULES, len(secret_scan.BASE)))
def op10_secret_scan(spark, folder):
    found = secret_scan.scan(_table(spark, folder, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["ord"] < len(secret_scan.BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(r.kind) for r in secret_scan.BASE],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
    )


@query("op12_periodic_runs")
def op12_periodic_runs(spark, folder):
    found = periodic_runs.describe_runs(_table(spark, folder, "documents", "doc_id", "text"), varied=True)
    return found.drop("n_words")


@query("op13_spelling_variants")
def op13_spelling_variants(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text")
    return spelling.group_variants(docs, slips=True).select("word", "form", "root", "n", "n_near", "form_n")


@query("op11_pii_bootstrap")
def op11_pii_bootstrap(spark, folder):
    found = pii_bootstrap.extract(_table(spark, folder, "documents", "doc_id", "text")).spans
    base = F.filter("spans", lambda s: s["by"] == "base")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii_bootstrap.KINDS),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
    )
