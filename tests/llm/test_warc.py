import hashlib

import pytest

from docloom.llm import warc


def pages(spark):
    big = "<p>é</p>\r\n\r\nWARC/1.0\r\n" * 60
    rows = [
        (1, "http://a/", big, "x"), (2, "http://b/\r\nEvil: 1", big, "x"), (5, None, big, None), (3, "http://c/", "small", "x"),
        (4, "http://c/", "small", "x"), (6, "", None, "x"), (7, "u", "", "x"), (8, "u", big + ".", "x"), (-9, "u", big + ".", "x"),
    ]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(4)


def test_round_trip(spark, tmp_path):
    rows, frame = pages(spark)
    warc.write_archive(frame, f"{tmp_path}/a")
    out = {r["page_id"]: r for r in warc.read_archive(spark, f"{tmp_path}/a").collect()}
    assert len(out) == len(rows)
    keeper = {}
    for i, _, html, _ in rows:
        keeper[html or ""] = max(keeper.get(html or "", i), i)
    for i, _, html, _ in rows:
        payload, r = (html or "").encode(), out[i]
        again = len(payload) >= 1000 and keeper[html or ""] != i
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha1(payload).hexdigest()
        assert r["record_type"] == ("revisit" if again else "response")
        assert r["refers_to"] == (keeper[html or ""] if again else None)
        assert bytes(r["payload"]) == payload
    records = {r["page_id"]: bytes(r["record"]) for r in warc.record_bytes(warc.read_archive(spark, f"{tmp_path}/a")).collect()}
    assert records[5].startswith(b"WARC/1.0\r\nWARC-Type: response\r\n") and records[5].endswith(rows[0][2].encode() + b"\r\n\r\n")
    assert b"WARC-Refers-To: <urn:page:5>" in records[1] and b"\r\nEvil" not in records[2]
    head, _, block = records[5].partition(b"\r\n\r\n")
    assert int(head.rsplit(b"Content-Length: ", 1)[1].split()[0]) == len(block) - 4


def test_payloads_are_stored_once(spark, tmp_path):
    _, frame = pages(spark)
    warc.write_archive(frame, f"{tmp_path}/a")
    stored = spark.read.parquet(f"{tmp_path}/a/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == 4


def test_damage_is_found(spark, tmp_path):
    _, frame = pages(spark)
    warc.write_archive(frame, f"{tmp_path}/a")
    spark.read.parquet(f"{tmp_path}/a/payloads").selectExpr("digest", "concat(payload, X'00') payload").write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, f"{tmp_path}/b").collect()
    spark.read.parquet(f"{tmp_path}/a/payloads").limit(0).write.parquet(f"{tmp_path}/c/payloads")
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/c/headers")
    with pytest.raises(Exception, match="missing or another"):
        warc.read_archive(spark, f"{tmp_path}/c").collect()


def test_empty_table_and_odd_ids(spark, tmp_path):
    _, frame = pages(spark)
    warc.write_archive(frame.limit(0), f"{tmp_path}/a")
    assert warc.read_archive(spark, f"{tmp_path}/a").count() == 0
    big = "b" * 2000
    rows = [(None, "u", big), (None, "v", big), (3, "w", big), (3, "w", big), (None, None, None), (5, "x", "y")]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/n")
    out = warc.read_archive(spark, f"{tmp_path}/n").collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in out) == [
        (0, "response", 0), (0, "revisit", 3), (0, "revisit", 3), (3, "response", 0), (3, "revisit", 3), (5, "response", 0)
    ]
    assert spark.read.parquet(f"{tmp_path}/n/payloads").count() == 3


def test_no_url_looks_like_a_field(spark, tmp_path):
    marks = ["\u0085", "\u2028", "\u2029", "\r", "\n", "\r\n", "\x0b", "\x0c", "%0D", " "]
    fake = "WARC-Payload-Digest: sha1:" + "0" * 40
    rows = [(k, f"http://a/{m}WARC-Refers-To: <urn:page:2>{m}{fake}{m}Content-Length: 7{m}", f"<p>{k}</p>{m}é") for k, m in enumerate(marks)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r for r in warc.archive_pages(frame, f"{tmp_path}/a").collect()}
    for k, url, html in rows:
        r, payload, want = out[k], html.encode(), url.replace("\r", "%0D").replace("\n", "%0A")
        assert (r["url"], r["record_type"], r["refers_to"]) == (want, "response", None)
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha1(payload).hexdigest()
        lines = [
            "WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:page:{k}>", f"WARC-Date: {warc.DATE}", f"WARC-Target-URI: {want}",
            "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}", f"Content-Length: {len(payload)}",
        ]
        assert bytes(r["record"]) == "\r\n".join([*lines, "", ""]).encode() + payload + b"\r\n\r\n"


def test_rebuilt_facts(spark, tmp_path):
    rows, frame = pages(spark)
    out = {r["page_id"]: r for r in warc.archive_pages(frame, f"{tmp_path}/a").collect()}
    for i, _, html, _ in rows:
        payload = (html or "").encode()
        assert out[i]["payload_bytes"] == len(payload) and out[i]["payload_digest"] == hashlib.sha1(payload).hexdigest()
        assert bytes(out[i]["record"]).endswith((payload if out[i]["record_type"] == "response" else b"") + b"\r\n\r\n")
