"""Vector functions on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(col: Column) -> Column:
    """Any numeric array as array<double>."""
    return col.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    """Inner product."""
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def squared_euclidean(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    return F.sqrt(squared_euclidean(a, b))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def argmax(values: Column) -> Column:
    """Position (from 0) of the first largest entry."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
