"""Clusters of integer vectors by a bisector tournament.

Of two centroids a < b, a point x is at least as near to a exactly if
2 (b - a) . x <= |b|^2 - |a|^2. Normals and thresholds of all pairs are made
once a round; each point then plays the centroids in order, and k - 1 signs
leave the nearest one. All numbers are integers, so no rounding decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentry.sources.workspace import discard, stage

from .common import released
from .vectors import CELLS, SUMS, add_by_group, floored, list_column, matrices, matrix_of, moved, sums_batch


class Clustering(NamedTuple):
    assigned: DataFrame  # id, cluster, distance (squared, to the centroid)
    centroids: DataFrame  # cluster, centroid


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal and threshold of each pair [a, b]; b is nearer where normal . x exceeds the threshold."""
    squares = (centroids**2).sum(1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), squares[None, :] - squares[:, None]


def tournament(points: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The number of each point's nearest centroid; of equally near ones the smallest."""
    winner = np.zeros(len(points), np.int64)
    for rival in range(1, len(thresholds)):
        side = np.einsum("ij,ij->i", points, normals[winner, rival]) - thresholds[winner, rival]
        winner[side > 0] = rival  # zero favours the smaller number, which is the winner so far
    return winner


def bisector_clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64, seed: int = 1,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> Clustering:
    """Centroids of the floored vectors after some rounds, and each vector's nearest one.

    Vectors of exactly ``width`` components, none null or non-finite, take part;
    the others get no row. Centroids start as the vectors with the least SHA-256
    of ``<seed>:<id>``; a null id counts as empty text, rows with one id follow
    each other by their components. Fewer than k vectors make fewer centroids,
    an empty table none and no rows. Repeated rows count, and are returned, as
    often as they stand. Components that exceed 2**27 when scaled are an error.

    The k centroids and their k * k normals are the only things that reach the
    driver or every task; a task sends one sum per centroid and component.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column("vector")):
                if matrix.shape[1] == width:
                    points = list_column(floored(matrix, scale), pa.int32())
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), points], ["id", "point"])

    points = stage(rows.mapInArrow(released(whole), f"id {kind}, point array<int>"), "points")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = points.orderBy(name, "point").limit(k).collect()
    centroids = np.array([r["point"] for r in first], np.int64).reshape(len(first), width)
    for _ in range(rounds if first else 0):
        centroids = moved(centroids[None], points.mapInArrow(_summing(centroids), SUMS))[0]
    assigned = points.mapInArrow(_assigning(centroids), f"id {kind}, cluster int, distance bigint")
    found = points.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(centroids.tolist())], "cluster int, centroid array<bigint>"
    )
    assigned = stage(assigned, "clusters")
    discard(points)
    return Clustering(assigned, found)


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(CELLS // width, 1)
    for low in range(0, batch.num_rows, step):
        some = batch.slice(low, step)
        yield some, matrix_of(some.column("point"), width).astype(np.int64)


def _summing(centroids: np.ndarray):
    normals, thresholds = bisectors(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, points in _slices(batch, centroids.shape[1]):
                add_by_group(totals, counts, tournament(points, normals, thresholds), points)
        yield sums_batch(0, totals, counts)

    return released(run)


def _assigning(centroids: np.ndarray):
    normals, thresholds = bisectors(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, points in _slices(batch, centroids.shape[1]):
                winner = tournament(points, normals, thresholds)
                distance = ((points - centroids[winner]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array(winner.astype(np.int32)), pa.array(distance)],
                    ["id", "cluster", "distance"],
                )

    return released(run)
