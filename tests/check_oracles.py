"""Compare registered queries with their SQL: python tests/check_oracles.py [folder] [name ...]."""

from __future__ import annotations

import os
import sys
import time
import traceback
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in records)


def compare(frame, con, sql):
    """None when equal, else a description of the difference."""
    got = frame.collect()
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    wrong = {
        c: (t, types[c])
        for c, t in frame.dtypes
        if kinds.get(t, t) not in types[c] and not (t == "string" and types[c] == "STRING")
        and not (t == "int" and types[c] == "NUMBER") and not (types[c] == "NUMBER" and t in ("bigint", "double"))
    }
    a, b = rows_of(frame.columns, [tuple(r) for r in got]), rows_of(names, want)
    if any(isinstance(x, Decimal) for r in want[:50] for x in r):
        return "decimal in SQL result"
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        return f"{len(got)} rows against {len(want)}; {len(left)} only here, {len(right)} only there:\n  {sorted(left)[:2]}\n  {sorted(right)[:2]}"[:1500]
    return f"types {wrong}" if wrong else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = duck(folder), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            fault = compare(run(spark, folder), con, checks.get(name))
        except Exception as error:
            fault = "".join(traceback.format_exception_only(error))[:1500]
        if fault:
            bad.append(name)
        kind = "sql " if name in checks else "rows"
        print(f"{'FAIL' if fault else 'ok  '} {kind} {name} {time.time() - started:.1f}s {fault or ''}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
