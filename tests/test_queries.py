"""Registered queries against their SQL on the smallest tables.

A quick choice runs by default; DOCLOOM_ALL_QUERIES=1 runs every query. The script
``tests/check_oracles.py`` does the same for any folder.
"""

import os

import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUICK = (
    "join_metadata dedupe_docs describe_text zip_by_position get_breaks clean_text tokenize clean_tokens "
    "term_stats tfidf_l2 covariance lloyd_step silhouette_exact epsilon_join search search_batch read_papers"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()) if os.environ.get("DOCLOOM_ALL_QUERIES") else QUICK)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql().get(name)) is None


def test_entry_answers(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"cluster_id", "score"}


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
