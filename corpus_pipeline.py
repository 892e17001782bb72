"""Corpus pipeline: quality classifier, quality rules, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and reread
before the next one; all but the last return the columns of ``documents``. Every stage takes null
values in any column, empty and very long texts, repeated rows, empty tables and further columns;
what each of them means is stated in the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from docloom.llm import ngram_join, packing, quality_model, quality_rules, secret_scan
from docloom.llm.common import crc_mod
from docloom.runtime import materialize

ACCEPT = 0.7
TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096


def classify(spark, docs, sf_dir):
    """Keep what the quality classifier scores at ``ACCEPT`` or more; it learns from three quarters of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality_model.fit(docs, labels.where(crc_mod(F.col("doc_id"), 4) != 2))
    inner = docs.withColumnsRenamed({"score": "_d_score"})
    scored = quality_model.score(inner, model).where(F.col("score") >= ACCEPT)
    return scored.select(*[F.col(f"`{c}`") for c in inner.columns]).toDF(*docs.columns)


def rules(spark, docs, sf_dir):
    """Keep what passes the base rules and the fences of its language and source."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """Keep the smallest id of every group of texts that share 80 % of their five-word shingles."""
    return ngram_join.deduplicate(docs, n=5, num=80, den=100)


def secrets(spark, docs, sf_dir):
    """Mask every secret; ``n_chars`` follows the text."""
    inner = docs.withColumnsRenamed({c: f"_d_{c}" for c in docs.columns if c == "spans" or c.startswith("_s_")})
    masked = secret_scan.mask(secret_scan.scan(inner), "text", "n_chars")
    return masked.select(*[F.col(f"`{c}`") for c in inner.columns]).toDF(*docs.columns)


def pack(spark, docs, sf_dir):
    """Tokenize and pack: one row per piece with its sequence and offset."""
    packed = packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER), CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]

# The fitted classifier has no SQL form: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
