"""Clustering of integer vectors whose nearest centroids are found by mean and deviation.

Equal-average equal-variance search: for vectors of ``d`` components with component sums
``s`` and deviations ``v`` (``v * v`` is ``d`` times the sum of squares less ``s * s``), the
squared distance ``D`` satisfies ``d * D >= (s1 - s2)**2 + (v1 - v2)**2``. Centroids are sorted
by their sums; from the place of a vector's sum the search goes outward, ends where the sums
alone exceed the best distance found, skips centroids by their deviations, and settles the
others in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm.shipping import ship_package
from cardlake.session import stage

# All centroids go to every task: at most this many components (32 MB).
MAX_CENTROID_VALUES = 1 << 22
BLOCK_ROWS = 2048

# Deviations are rounded square roots of whole numbers up to 2**60, each off by less than 1e-6.
_SLACK = 1e-5


def component_limit(dimension: int) -> int:
    """Components up to this size keep every whole number of the search within 64 bits."""
    return (1 << 30) // dimension


class CentroidSearch:
    """Centroids in the order of their component sums."""

    def __init__(self, centroids: np.ndarray) -> None:
        sums = centroids.sum(axis=1)
        self.numbers = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.numbers], sums[self.numbers]
        self.deviations = self._deviations(self.centroids, self.sums)
        self.computed = 0  # exact distances so far

    @staticmethod
    def _deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", vectors, vectors)
        return np.sqrt((vectors.shape[1] * squares - sums * sums).astype(np.float64))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid; of equals the smaller number."""
        count, dimension = vectors.shape
        last = len(self.sums)
        sums = vectors.sum(axis=1)
        deviations = self._deviations(vectors, sums)
        above = np.searchsorted(self.sums, sums)
        below = above - 1
        # More than any distance of vectors within the limit, and a gap beyond all of those.
        best = np.full(count, (1 << 62) // dimension + 1, dtype=np.int64)
        found = np.full(count, last, dtype=np.int64)
        beyond = np.int64((1 << 31) + 1)
        going = np.arange(count)
        while len(going):
            up, down = above[going], below[going]
            gap_up = np.where(up < last, self.sums[np.minimum(up, last - 1)] - sums[going], beyond)
            gap_down = np.where(down >= 0, sums[going] - self.sums[np.maximum(down, 0)], beyond)
            upward = gap_up <= gap_down
            gap = np.where(upward, gap_up, gap_down)
            within = gap * gap <= dimension * best[going]  # else no centroid further out is nearer
            going, upward, gap = going[within], upward[within], gap[within]
            place = np.where(upward, up[within], down[within])
            above[going] += upward
            below[going] -= ~upward
            apart = np.maximum(np.abs(deviations[going] - self.deviations[place]) - _SLACK, 0.0)
            possible = apart * apart + (gap * gap).astype(np.float64) <= dimension * best[going] * (1 + 1e-12)
            row, place = going[possible], place[possible]
            difference = vectors[row] - self.centroids[place]
            distance = np.einsum("ij,ij->i", difference, difference)
            self.computed += len(row)
            number = self.numbers[place]
            nearer = (distance < best[row]) | ((distance == best[row]) & (number < found[row]))
            best[row[nearer]], found[row[nearer]] = distance[nearer], number[nearer]
        return found, best


@dataclass
class Clustering:
    """Final centroids, and per kept vector its id, ``cluster`` and ``distance`` (squared)."""

    centroids: np.ndarray
    assigned: DataFrame


def _blocks(column: pa.Array, dimension: int) -> Iterator[np.ndarray]:
    """Rows of a list column without nulls as whole-number matrices."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    for low in range(0, len(values), BLOCK_ROWS):
        yield values[low:low + BLOCK_ROWS].astype(np.int64)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of the means of the vectors nearest to each.

    Every task adds up its own rows; only sums per centroid and component are shuffled and,
    added up, brought to the driver.
    """
    k, dimension = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = CentroidSearch(centroids)
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimension), dtype=np.int64)
        for batch in batches:
            for block in _blocks(batch.column(0), dimension):
                own, _ = search.nearest(block)
                counts += np.bincount(own, minlength=k)
                order = np.argsort(own, kind="stable")
                owners, starts = np.unique(own[order], return_index=True)
                sums[owners] += np.add.reduceat(block[order], starts, axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64()),
             pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = vectors.select("vector").mapInArrow(add, "cluster long, n long, sums array<long>")
    totals = (
        parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(19,0)")).alias("total"))
    )
    moved = centroids.copy()
    for r in totals.collect():
        moved[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return moved


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimension: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> Clustering:
    """k-means in whole numbers, the same at every run and on any number of tasks.

    Kept are vectors with exactly ``dimension`` components, none null or non-finite; each
    component ``x`` becomes ``floor(scale * x)``. Centroids start as the ``k`` kept vectors
    with the smallest SHA-256 of seed and id (a null id counts as an empty one, equal ids
    follow their components). Every round replaces each centroid that has vectors by the floor
    of their means; rounds that would change nothing are left out. Fewer kept vectors give
    fewer centroids, none give an empty result. Rows that repeat an id are vectors of their own.

    A vector with a component beyond ``component_limit(dimension)`` after scaling (16,384 before
    it at 64 components and a scale of 1,024) takes no part, as its distances may not fit 64
    bits; its row has no cluster and no distance.

    Vectors are scaled once and stored; a round is one scan with sums per task. Refuses more
    than ``MAX_CENTROID_VALUES`` components in all centroids.
    """
    if k < 1 or k * dimension > MAX_CENTROID_VALUES:
        raise ValueError(f"centroids must have 1 to {MAX_CENTROID_VALUES} components in all, not {k} x {dimension}")
    ship_package(vectors.sparkSession)
    limit = float(component_limit(dimension))
    given = F.col(vector_column).cast("array<double>")
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(given, lambda x: F.floor(x * float(scale)))
    fits = F.forall(given, lambda x: F.abs(x * float(scale)) < limit)
    kept = vectors.where((F.size(given) == dimension) & finite).select(
        F.col(id_column).alias("vec_id"), F.when(fits, F.transform(scaled, lambda x: x.cast("int"))).alias("vector"))
    kept = stage(kept, "scaled-vectors")
    taking_part = kept.where("vector IS NOT NULL")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = taking_part.select(place.alias("place"), "vector").orderBy("place", "vector").limit(k).collect()
    centroids = np.array([r["vector"] for r in first], dtype=np.int64).reshape(-1, dimension)
    for _ in range(rounds if len(centroids) else 0):
        moved = _moved(taking_part, centroids)
        if (moved == centroids).all():
            break
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = CentroidSearch(centroids)
        for batch in batches:
            found = [search.nearest(block) for block in _blocks(batch.column(1), dimension)]
            own, distances = (np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.int32()), pa.array(distances, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    assigned = taking_part.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")
    apart = kept.where("vector IS NULL").select(
        "vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    return Clustering(centroids, stage(assigned.unionByName(apart).withColumnRenamed("vec_id", id_column), "clusters"))
