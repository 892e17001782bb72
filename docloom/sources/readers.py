"""Readers. All of them are lazy and keep what later steps need to restore file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import flatten_sections
from docloom.operators.corpus import union_parts, with_row_id
from docloom.operators.search import parse_taggings

_SECTIONS = "array<struct<text:string>>"
PAPER_SCHEMA = (
    f"paper_id string, abstract {_SECTIONS}, body_text {_SECTIONS}, _corrupt_record string"
)
METADATA_COLUMNS = (
    "sha", "title", "authors", "journal", "doi", "pubmed_id", "Microsoft Academic Paper ID",
)


def file_order() -> Column:
    """Orders rows as their files do: file, offset of the split, place within the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("place"),
    )


def read_papers(
    spark: SparkSession, path: str | Sequence[str], lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Papers below ``path``: ``(good, rejected)``.

    One JSON object per file, searched recursively, or one per line with ``lines`` (the
    layout to prefer for large corpora). Only the three keys in use are parsed. A record
    that is not valid JSON, or lacks a key or a section text, is rejected.
    """
    raw = (
        spark.read.schema(PAPER_SCHEMA)
        .option("multiLine", not lines)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path if isinstance(path, str) else list(path))
        .withColumn("file", F.col("_metadata.file_path"))
    )
    whole = F.col("_corrupt_record").isNull() & F.col("paper_id").isNotNull()
    for name in ("abstract", "body_text"):
        texts = F.forall(F.col(name), lambda s: s["text"].isNotNull())
        whole = whole & F.coalesce(texts, F.lit(False))
    good = raw.where(whole).select(
        "paper_id",
        flatten_sections(F.col("abstract")).alias("abstract"),
        flatten_sections(F.col("body_text")).alias("body_text"),
    )
    return good, raw.where(~whole).select("file", "paper_id", "_corrupt_record")


def read_metadata(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Metadata CSV with header. Every column stays a string; blanks are null.

    ``meta_order`` is the order in the file. Without line breaks inside quotes,
    ``multi_line=False`` lets Spark split large files.
    """
    raw = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    known = [c for c in METADATA_COLUMNS if c in raw.columns]
    return raw.select(
        *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in known],
        file_order().alias("meta_order"),
    )


def read_vectors(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", number: bool = True
) -> DataFrame:
    """Vectors as (doc_id, vec). Parquet carries its ids.

    Headerless CSV has one row per document and no id: rows are numbered from 0 in file
    order, the files of a list in list order. ``number=False`` returns the order column
    instead of computing ids.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "parquet":
        return spark.read.parquet(*paths).select("doc_id", "vec")

    def part(index: int, one: str) -> DataFrame:
        cells = F.transform(F.split("value", ",", -1), lambda x: F.trim(x).cast("double"))
        return (
            spark.read.text(one)
            .where(F.trim("value") != "")
            .select(cells.alias("vec"), F.struct(F.lit(index).alias("part"), file_order().alias("at")).alias("position"))
        )

    rows = union_parts(*[part(i, p) for i, p in enumerate(paths)])
    if not number:
        return rows
    return with_row_id(rows, ["position"], "doc_id", start=0).select("doc_id", "vec")


def read_clusters(
    spark: SparkSession, path: str, schema: str | None = "doc_id long, cluster_id int"
) -> DataFrame:
    """Assignment CSV with header; malformed rows are dropped. ``schema=None`` infers it.

    Lines are split and cast here: the CSV reader judges a row only by the columns that are
    selected, so a count would see other rows than a full read. A row is whole when it has
    as many fields as the schema and every field that is not blank has its type.
    """
    if schema is None:
        inferred = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
        kinds = [(f.name, f.dataType.simpleString()) for f in inferred]
    else:
        kinds = [tuple(field.split()) for field in schema.split(",")]
    fields = F.transform(F.split("value", ",", -1), lambda x: F.trim(F.regexp_replace(F.trim(x), '^"|"$', "")))
    rows = spark.read.text(path).select(fields.alias("_f")).where(F.col("_f") != F.array(*[F.lit(n) for n, _ in kinds]))
    whole = F.size("_f") == len(kinds)
    for i, (_, kind) in enumerate(kinds):
        cell = F.get("_f", F.lit(i))
        whole = whole & ((cell == "") | cell.try_cast(kind).isNotNull())
    return rows.where(whole).select(*[F.get("_f", F.lit(i)).try_cast(k).alias(n) for i, (n, k) in enumerate(kinds)])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Single-column prediction CSV: the first line is skipped. (prediction, position)."""
    return (
        spark.read.schema("prediction int")
        .option("header", True)
        .option("enforceSchema", True)
        .csv(path)
        .select("prediction", file_order().alias("position"))
    )


def read_taggings(spark: SparkSession, path: str) -> DataFrame:
    """Tag file to (tag, cluster_id, line, position); see ``parse_taggings``."""
    return parse_taggings(spark.read.text(path).select("value", file_order().alias("line")))
