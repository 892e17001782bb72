"""Readers and writers on files."""

import json

import pytest

from docloom import runtime
from docloom.sources import readers, writers

GOOD = {"paper_id": "p1", "abstract": [{"text": "a"}, {"text": "b"}], "body_text": [{"text": "c", "section": "s"}], "other": 1}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    cases = {
        "good.json": json.dumps(GOOD, indent=2),
        "deep/er/empty.json": json.dumps({"paper_id": "p2", "abstract": [], "body_text": []}),
        "cut.json": json.dumps(GOOD)[:40],
        "deep/none.json": json.dumps({"paper_id": "p3", "body_text": []}),
        "deep/blank.json": json.dumps({"paper_id": "p4", "abstract": [{"section": "x"}], "body_text": []}),
        "readme.txt": "not a paper",
    }
    for name, text in cases.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_read_papers(spark, folder):
    good, rejected = readers.read_papers(spark, folder)
    assert sorted(tuple(r) for r in good.collect()) == [("p1", "a\nb", "c"), ("p2", "", "")]
    assert sorted(r["file"].rsplit("/", 1)[1] for r in rejected.collect()) == ["blank.json", "cut.json", "none.json"]


def test_read_metadata(spark, tmp_path):
    path = tmp_path / "metadata.csv"
    path.write_text('n,sha,title,authors,doi,pubmed_id\n1,p1,"A ""b"",\nc",X;Y,0012,0034\n2,p1,late,,,\n3,,none,Z,1,2\n')
    rows = readers.read_metadata(spark, str(path)).orderBy("meta_order").collect()
    assert [r["sha"] for r in rows] == ["p1", "p1", None]
    assert rows[0]["title"] == 'A "b",\nc' and rows[0]["doi"] == "0012" and rows[1]["authors"] is None


def test_vectors_without_ids_come_back_in_order(spark, vectors, tmp_path):
    matrix = [[i + 0.5, -i / 7, 1e-9 * i] for i in range(57)]
    df = vectors(spark, matrix, partitions=5)
    paths = [str(tmp_path / f"part{i}") for i in (10, 2)]
    for path in paths:
        writers.write_vectors(df, path, "csv")
    back = readers.read_vectors(spark, paths).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in back] == list(range(114))
    assert [r["vec"] for r in back] == matrix + matrix


def test_clusters_and_taggings(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3 - 1) for i in range(20)], "doc_id long, cluster_id int").repartition(4)
    path = str(tmp_path / "c")
    writers.write_clusters(df, path)
    assert sorted(tuple(r) for r in readers.read_clusters(spark, path).collect()) == sorted(tuple(r) for r in df.collect())
    bad = tmp_path / "bad.csv"
    bad.write_text("doc_id,cluster_id\n1,2\nx,y\n3,4\n")
    assert sorted(tuple(r) for r in readers.read_clusters(spark, str(bad)).collect()) == [(1, 2), (3, 4)]
    tagged = spark.createDataFrame([(1, ["a b", "c"]), (0, ["d"])], "cluster_id int, tags array<string>")
    writers.write_taggings(tagged, str(tmp_path / "tags"))
    got = readers.read_taggings(spark, str(tmp_path / "tags")).orderBy("line", "position").collect()
    assert [(r["tag"], r["cluster_id"], r["position"]) for r in got] == [("d", 0, 0), ("a b", 1, 0), ("c", 1, 1)]


def test_malformed_lines_are_the_same_for_every_choice_of_columns(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("doc_id,cluster_id\n1,2\nx,y\n3,4\n5,zz\n6\n7,8,9\n10,\n")
    rows = readers.read_clusters(spark, str(bad))
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2), (3, 4), (10, None)]
    assert rows.count() == 3 and sorted(r["doc_id"] for r in rows.select("doc_id").collect()) == [1, 3, 10]


def test_search_result_header(spark, tmp_path):
    writers.write_search(spark.createDataFrame([(3, 0.5)], "cluster_id int, score double"), str(tmp_path / "s"))
    parts = [f.read_text().splitlines() for f in (tmp_path / "s").glob("*.csv")]
    assert {p[0] for p in parts} == {"cluster number, probability"}
    assert [line for p in parts for line in p[1:]] == ["3,0.5"]


def test_scratch_follows_the_session_setting(spark):
    set_by_session = spark.conf.get("spark.checkpoint.dir", None)
    root = runtime.shared_root(spark)
    assert not set_by_session or root == set_by_session
    assert runtime.scratch_path(spark, "x").startswith(root)


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(3)
    hinted = runtime.broadcast_bounded(df, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower()
    assert runtime.broadcast_bounded(df, 10**9) is df
