import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402
from docloom.llm import quality_model, secret_scan  # noqa: E402

from .test_ngram_join import brute  # noqa: E402
from .test_quality import brute_measure, labelled  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    rows = labelled()
    long, other = [t for _, t, y in rows if y and len(t.split()) > 90][:2]
    extra = [(5000, long), (5001, long), (5002, long + " token=abcdefgh12 more"), (5003, "Key AKIA" + "Q" * 14 + " " + other[:-9]), (5004, None), (5005, "")]
    docs = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", len(t or ""), i) for i, t in [(r[0], r[1]) for r in rows] + extra]
    docs += [(None, long + " null id", None, None, None, 0), (5003, "Key AKIA" + "Q" * 14 + " " + other[:-9], "en", "s1", 7, 1)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, spans int"
    spark.createDataFrame(docs, kinds).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int").write.parquet(f"{out}/labels.parquet")
    return out


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), [spark.read.parquet(f"{folder}/documents.parquet")]
    place = tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
        out.append(docs)
    return out


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_classifier_stage(spark, folder, stages):
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label")
    train = [r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    one = quality_model.fit(stages[0], labels.where(F.col("doc_id").isin(train))).scorer()
    want = [tuple(r) for r in stages[0].collect() if one((r["text"] or "").encode()) >= 0.7]
    assert rows_of(stages[1]) == sorted(want, key=repr) and len(want) < stages[0].count()


def test_rules_stage(stages):
    before = stages[1].collect()
    good = [r for r in before if (m := brute_measure(r["text"]))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    left = rows_of(stages[2])
    assert set(left) <= {tuple(r) for r in good} and len(left) >= 0.95 * len(good)


def test_duplicate_stage(stages):
    before = stages[2].collect()
    ids = {k: r["text"] for k, r in enumerate(before)}
    want = brute(list(ids.items()), 5, 80, 100)
    left = stages[3].collect()
    texts = {r["text"] for r in left}
    assert len(left) == len({c for _, c in want.values()}) and len(left) < len(before)
    groups = {}
    for k, (_, c) in want.items():
        groups.setdefault(c, set()).add(ids[k])
    assert all(len(g & texts) >= 1 for g in groups.values())


def test_secret_stage(stages):
    left = stages[4].collect()
    assert len(left) == stages[3].count()
    assert any(secret_scan.MASK in r["text"] for r in left) and not any("AKIA" in r["text"] for r in left)
    assert all(r["n_chars"] == len(r["text"]) for r in left if secret_scan.MASK in r["text"])


def test_packing_stage(stages):
    rows = stages[5].collect()
    assert len({(r["doc_id"]) for r in rows}) == len({r["doc_id"] for r in stages[4].collect()})
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in filled.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= pipeline.CAPACITY


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
