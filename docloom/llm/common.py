"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.runtime import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n: a stable way to deal rows out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def with_keys(frame: DataFrame, id_col: str, key: str = "_row_number") -> tuple[DataFrame, str]:
    """A frame and the name of a column that is unique and not null in it.

    That is the id itself where it qualifies. Otherwise rows get numbers, which are written
    to the shared folder together with the rows, so that every later pass sees the same ones.
    """
    ids = frame.groupBy(id_col).count()
    if ids.where((F.col("count") > 1) | F.col(id_col).isNull()).isEmpty():
        return frame, id_col
    return materialize(frame.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def by_ids(found: DataFrame, keyed: DataFrame, key: str, id_col: str) -> DataFrame:
    """Results by key (with a ``component_id`` that is a key) as results by id: the smallest id of the component."""
    names = keyed.select(F.col(key).alias("_k"), F.col(id_col).alias("_id"))
    joined = found.join(names, found[key] == F.col("_k"))
    least = joined.groupBy("component_id").agg(F.min("_id").alias("_least"))
    renamed = joined.join(least, "component_id").drop("component_id", key, "_k")
    return renamed.withColumnsRenamed({"_id": id_col, "_least": "component_id"})
