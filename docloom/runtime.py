"""Session-level helpers: shared scratch tables, size-checked broadcasts, timing."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from typing import TypeVar

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import kernels

T = TypeVar("T")

# A frame is broadcast only when rows x row bytes is known to stay below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Model state (centres, codebooks, query vectors) held by the driver stays below this.
MODEL_BYTES = 256 * 1024 * 1024
# The columns of ``kernels.blocks``
SUMS = "model int, part int, cells binary"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """Folder for scratch tables that every executor can reach.

    ``spark.checkpoint.dir`` wins, then the context's own checkpoint folder. A
    temporary folder is made only in local mode, where driver and executors share a disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="docloom-")
    sc.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application for later clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/docloom/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``by``, its last column, divides the files.

    Cuts the lineage of iterative jobs, fixes values that depend on partition layout
    (ids, positions), and survives the loss of executors because the files are shared.
    The shuffle files of the write go with its end.
    """
    path, conf = scratch_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(FILE_CLEANUP, None)
    conf.set(FILE_CLEANUP, "true")  # else shuffle files lie on the disks until the driver collects its garbage
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        conf.unset(FILE_CLEANUP) if before is None else conf.set(FILE_CLEANUP, before)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._scratch = path
    return written


def forget(df: DataFrame) -> None:
    """Delete the files of a frame made by ``materialize`` that a later stage has replaced."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer splits than the session has cores.

    Tables of many files already have more splits and pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """(doc_id, vec) written in parts of even size, at least one for each core: a table of few row groups keeps few cores busy."""
    rows = df.select("doc_id", "vec")
    parts = max(df.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    return materialize(rows.repartition(parts, "doc_id"), "vectors")


def at_least(df: DataFrame, rows: int, least: int) -> DataFrame:
    """Fewer partitions where they would hold less than ``least`` of the ``rows`` rows on average.

    For scans whose tasks return a result of fixed size, however few rows they read.
    """
    wanted = max(1, rows // least)
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df


def summed(rows: DataFrame, shapes: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """The sum over all tasks of the matrices they gave as ``kernels.blocks``, by key; zeros where no task gave any.

    Numbers travel as bytes and are added in tasks, some rows of a matrix in each.
    """
    total = {key: np.zeros(shape) for key, shape in shapes.items()}
    cores = rows.sparkSession.sparkContext.defaultParallelism
    added = rows.repartition(cores, "model", "part").mapInArrow(kernels.add_blocks, SUMS)
    for batch in added.toArrow().to_batches():
        for key, part, values in kernels.block_values(batch):
            width = total[key].shape[1]
            low = part * max(1, kernels.BLOCK_CELLS // width)
            total[key][low : low + len(values) // width] = values.reshape(-1, width)
    return total


def broadcast_bounded(df: DataFrame, max_rows: int, row_bytes: int = 64) -> DataFrame:
    """Broadcast ``df`` when its proven row bound makes it small.

    Past the bound the frame is returned untouched and Catalyst/AQE choose a shuffled join.
    """
    return F.broadcast(df) if max_rows * row_bytes <= BROADCAST_BYTES else df


def timed(action: Callable[[], T]) -> tuple[T, float]:
    """Run ``action`` and return its result with the wall seconds it took."""
    started = time.perf_counter()
    result = action()
    return result, time.perf_counter() - started
