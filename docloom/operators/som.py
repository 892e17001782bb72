"""Self-organising map with the batch rule: one aggregation per iteration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import kernels
from docloom.operators.assign import nearest_in
from docloom.runtime import timed


@dataclass
class SelfOrganisingMap:
    """Assignments, the codebook (height x width rows), the cost of each iteration."""

    assignments: DataFrame
    codebook: np.ndarray
    history: list[float]
    seconds: float


def grid_kernel(height: int, width: int, radius: float) -> np.ndarray:
    """Gaussian neighbourhood between the cells of a rectangular grid."""
    cells = np.array([(r, c) for r in range(height) for c in range(width)], dtype=float)
    gap2 = ((cells[:, None, :] - cells[None, :, :]) ** 2).sum(axis=2)
    return np.exp(-gap2 / (2.0 * radius * radius))


def som_assign(df: DataFrame, codebook: np.ndarray) -> DataFrame:
    """(doc_id, vec) to (.., cluster_id, distance2): the best matching unit of each vector."""
    return nearest_in(df, np.arange(len(codebook), dtype=np.int32), codebook)


def som_step(
    df: DataFrame, codebook: np.ndarray, height: int, width: int, radius: float
) -> tuple[np.ndarray, float]:
    """One batch iteration: new codebook and the mean squared distance to the old one.

    The data is reduced to one sum vector per unit (combined map-side); only these reach the
    driver, which smooths them over the grid.
    """
    sums = (
        som_assign(df, codebook)
        .groupBy("cluster_id")
        .agg(
            Summarizer.sum(array_to_vector("vec")).alias("s"),
            F.count("*").alias("n"),
            F.sum("distance2").alias("cost"),
        )
        .collect()
    )
    s, n = np.zeros_like(codebook), np.zeros(len(codebook))
    for row in sums:
        s[row["cluster_id"]] = row["s"].toArray()
        n[row["cluster_id"]] = row["n"]
    cost = sum(row["cost"] for row in sums) / max(1.0, n.sum())
    weights = grid_kernel(height, width, radius)
    mass = weights @ n
    moved = np.where(mass[:, None] > 0, (weights @ s) / np.where(mass > 0, mass, 1.0)[:, None], codebook)
    return moved, cost


def initial_codebook(df: DataFrame, units: int, seed: int) -> np.ndarray:
    """``units`` vectors picked by a hash of their id; repeated when there are fewer rows."""
    picked = df.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(units).select("vec").collect()
    if not picked:
        raise ValueError("no vectors given")
    rows = kernels.stack(pd.Series([row["vec"] for row in picked]))
    return rows[np.arange(units) % len(rows)]


def som(
    df: DataFrame,
    height: int = 10,
    width: int = 10,
    iterations: int = 20,
    radius_start: float = 10.0,
    radius_end: float = 1.0,
    seed: int = 1,
    codebook: np.ndarray | None = None,
) -> SelfOrganisingMap:
    """Fit a map on (doc_id, vec); the radius falls geometrically over the iterations."""
    data = df.select("doc_id", "vec").persist(StorageLevel.MEMORY_AND_DISK)

    def train() -> tuple[np.ndarray, list[float]]:
        units = initial_codebook(data, height * width, seed) if codebook is None else codebook
        costs = []
        for step in range(iterations):
            share = step / max(1, iterations - 1)
            radius = radius_start * (radius_end / radius_start) ** share
            units, cost = som_step(data, units, height, width, radius)
            costs.append(float(cost))
        return units, costs

    try:
        (units, history), seconds = timed(train)
    finally:
        data.unpersist()
    assignments = som_assign(df.select("doc_id", "vec"), units).select("doc_id", "cluster_id")
    return SelfOrganisingMap(assignments, units, history, seconds)
