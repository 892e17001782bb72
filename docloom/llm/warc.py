"""Content-addressed WARC archive.

``write_archive`` gives every row a WARC/1.0 record. The exact bytes of each record's
header go to ``headers``; payload bytes go to ``payloads``, once for each SHA-256 digest.
``read_archive`` joins the two and verifies both digests of every stored payload; ``record_bytes``
puts the original records together again, and ``rebuilt`` takes a record's facts from those bytes.

A payload of at least ``min_revisit`` bytes that occurs more than once has one response (the
largest id) and revisit records; smaller ones are all responses, yet their bytes are stored
once as well.

Payloads are never moved to find copies: the digests are aggregated alone (map-side combined,
so a payload that a third of the rows share is no hot group), and the rows that do not
store their payload are taken out by an anti-join on ids.

Edge cases: a null or empty payload is the empty payload; null URLs give an empty target
URI; a carriage return or line feed in a URL is percent-encoded, any other character stays, and a header is cut at
CRLF only, so that no URL can look like a field; every row is a record of its own, also when its id is null or repeats (records are then told
apart by numbers, and a null id is written as ``-``); an empty table gives an empty archive;
further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import with_keys
from docloom.runtime import BROADCAST_BYTES, materialize, scratch_path

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"


def _bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _header(date: str) -> Column:
    """The header block of a record, without the blank line that ends it."""

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def name(page):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("-")), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", name("refers_to")),
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
            ),
        ).otherwise(F.lit("")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    )


def write_archive(pages: DataFrame, folder: str, min_revisit: int = 1000, date: str = DATE) -> None:
    """Write ``headers`` and ``payloads`` of (page_id, url, html) below ``folder``."""
    pages, key = with_keys(pages.select("page_id", "url", "html"), "page_id")
    payload = _bytes(F.coalesce("html", F.lit("")))
    facts = materialize(
        pages.select(
            "page_id", F.col(key).alias("key"), "url",
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            F.sha1(payload).alias("payload_digest"),
            F.sha2(payload, 256).alias("digest"),
        ),
        "warc-facts",
    )
    groups = materialize(
        facts.groupBy("digest").agg(F.max(F.struct("page_id", "key")).alias("keeper"), F.count("*").alias("n")).where("n > 1"),
        "warc-groups",
    )
    # narrow rows; one group row per digest, so AQE can split a hot digest
    roles = facts.join(groups, "digest", "left")
    second = F.col("keeper").isNotNull() & (F.col("keeper.key") != F.col("key"))
    revisit = second & (F.col("payload_bytes") >= min_revisit)
    roles = materialize(
        roles.select(
            "page_id", "key", "url", "payload_bytes", "payload_digest", "digest",
            F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            F.when(revisit, F.col("keeper.page_id")).alias("refers_to"), second.alias("copy"),
        ),
        "warc-roles",
    )
    roles.select("page_id", "digest", "record_type", "refers_to", _bytes(_header(date)).alias("header")).write.parquet(
        f"{folder}/headers"
    )
    copies = roles.where("copy").select("key")
    n = copies.count()
    copies = F.broadcast(copies) if n * 64 <= BROADCAST_BYTES else copies
    pages.select(F.col(key).alias("key"), payload.alias("payload")).join(copies, "key", "left_anti").select(
        F.sha2("payload", 256).alias("digest"), "payload"
    ).write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record: the fields of its header, the verified facts of its payload.

    A stored payload whose bytes do not have the digest of its name, a record without a stored
    payload, and a header whose SHA-1 is not that of the payload all fail the read.
    ``payloads=False`` leaves the bytes out of the join.
    """
    stored = spark.read.parquet(f"{folder}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    stored = stored.select(
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.lit("a payload does not match its digest"))).alias("digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        *(["payload"] if payloads else []),
    )
    headers = spark.read.parquet(f"{folder}/headers")
    lines = F.split(F.decode("header", "UTF-8"), CRLF)

    def field(name):
        found = F.get(F.filter(lines, lambda x: F.startswith(x, F.lit(f"{name}: "))), F.lit(0))
        return F.substr(found, F.lit(len(name) + 3))

    def page(name):
        return F.nullif(F.regexp_extract(field(name), r"\A<urn:page:(-?[0-9]+)>\z", 1), F.lit("")).cast("long")

    parsed = headers.select(
        page("WARC-Record-ID").alias("page_id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
        F.substr(field("WARC-Payload-Digest"), F.lit(len("sha1:") + 1)).alias("named"),
        "digest", "header",
    )
    joined = parsed.join(stored, "digest", "left")
    agrees = F.coalesce(F.col("named") == F.col("payload_digest"), F.lit(False))
    return joined.withColumn(
        "payload_digest",
        F.when(agrees, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record's payload is missing or another"))),
    ).drop("named")


def record_bytes(records: DataFrame) -> DataFrame:
    """(page_id, record): the original bytes of each record; a revisit has an empty block."""
    end = F.lit(CRLF.encode())
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.select("page_id", F.concat("header", end, block, end, end).alias("record"))


def rebuilt(records: DataFrame) -> DataFrame:
    """Records with ``record``, their original bytes, and the facts of the payload found in these bytes.

    The block is cut out of the rebuilt bytes by the length that the header states. A response must have the digest that
    its header names; a revisit, whose block is empty, has the facts of the stored payload that it stands for.
    """
    end = F.lit(CRLF.encode())
    response = F.col("record_type") != "revisit"
    block = F.when(response, F.col("payload")).otherwise(F.lit(b""))
    rows = records.withColumn("record", F.concat("header", end, block, end, end))
    stated = F.regexp_extract(F.decode("header", "UTF-8"), r"\r\nContent-Length: ([0-9]+)\r\n\z", 1).cast("int")
    cut = F.substr("record", F.octet_length("header") + len(CRLF) + 1, stated)
    sound = F.sha1(cut) == F.col("payload_digest")
    digest = F.when(~response | sound, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a rebuilt block is not its payload")))
    size = F.when(response, F.octet_length(cut).cast("long")).otherwise(F.col("payload_bytes"))
    return rows.withColumns({"payload_bytes": size, "payload_digest": digest})


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to an archive (in the shared folder unless one is named), read it and rebuild its records."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_archive(pages, folder)
    return rebuilt(read_archive(spark, folder))
