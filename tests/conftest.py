import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column function on single values: one(function, value, ...)."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", function(F.col("x")).alias("y"))
        return [r["y"] for r in df.orderBy("i").collect()]

    return run


@pytest.fixture(scope="session")
def vectors():
    """Make a (doc_id, vec) frame from a matrix."""

    def make(spark, matrix, start=0, partitions=3):
        rows = [(start + i, [float(x) for x in row]) for i, row in enumerate(matrix)]
        return spark.createDataFrame(rows, "doc_id long, vec array<double>").repartition(partitions)

    return make
