"""Vectors of Arrow list columns as matrices, and sums that tasks make of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LARGEST = 1 << 27  # larger integer components could take squared distances beyond a long
CELLS = 1 << 20  # components handled by one round of array operations


def matrices(column: pa.Array, limit: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, double matrix) of the sound vectors, each length apart, ``limit`` components at once.

    Null and empty vectors and those with a null or non-finite component are left out.
    """
    flat = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
    offsets = column.offsets.to_numpy().astype(np.int64)
    starts, lengths = offsets[:-1], np.diff(offsets)
    faults = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    sound = (faults[offsets[1:]] == faults[starts]) & (lengths > 0)
    if column.null_count:
        sound &= column.is_valid().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths[sound]).tolist():
        rows = np.flatnonzero(sound & (lengths == width))
        step = max(limit // width, 1)
        for low in range(0, len(rows), step):
            some = rows[low : low + step]
            yield some, flat[starts[some][:, None] + np.arange(width)]


def floored(matrix: np.ndarray, scale: int) -> np.ndarray:
    """Integer floors of the scaled components.

    A component beyond ``LARGEST`` is an error: the exact distances, which are longs, could not hold it.
    """
    whole = np.floor(matrix * scale)
    if whole.size and np.abs(whole).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}")
    return whole.astype(np.int64)


def list_column(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list per row of the matrix."""
    bounds = np.arange(len(matrix) + 1, dtype=np.int64) * matrix.shape[1]
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1), kind)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """The inverse of ``list_column``: lists of ``width`` numbers, none null."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def packed_column(matrix: np.ndarray, kind: type) -> pa.Array:
    """The bytes of each row of the matrix."""
    matrix = np.ascontiguousarray(matrix, kind)
    rows = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(matrix.shape[1] * matrix.itemsize), len(matrix), [None, pa.py_buffer(matrix)]
    )
    return rows.cast(pa.binary())


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """The inverse of ``packed_column``."""
    if not len(column):
        return np.zeros((0, 0), kind)
    _, offsets, data = column.cast(pa.binary()).buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return np.frombuffer(raw.tobytes(), kind).reshape(len(column), -1)


def exact_squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, in integers.

    The products go through doubles where these hold every sum exactly.
    """
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if points.shape[1] * (2 * largest) ** 2 < 1 << 53:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    squares = (points**2).sum(1)[:, None] + (entries**2).sum(1)[None, :] - 2 * (points @ entries.T)
    return squares.astype(np.int64)


def add_by_group(totals: np.ndarray, counts: np.ndarray, group: np.ndarray, points: np.ndarray) -> None:
    """Add each point to the totals, and one to the count, of its group."""
    order = np.argsort(group, kind="stable")
    found, first = np.unique(group[order], return_index=True)
    if len(found):
        totals[found] += np.add.reduceat(points[order], first)
        counts[found] += np.diff(np.append(first, len(order)))


SUMS = "book int, entry int, place int, total bigint, n bigint"


def sums_batch(book: int, totals: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """What a task found for the entries of a book, as rows of ``SUMS``."""
    used = np.flatnonzero(counts)
    width = totals.shape[1]
    columns = [
        pa.array(np.full(len(used) * width, book, np.int32)), pa.array(np.repeat(used, width).astype(np.int32)),
        pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))), pa.array(totals[used].reshape(-1)),
        pa.array(np.repeat(counts[used], width)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["book", "entry", "place", "total", "n"])


def moved(entries: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The entries (book x entry x place) after replacing each used one by the floor of its mean.

    The frame holds rows of ``SUMS``; a number per component reaches the driver, however many points there are.
    """
    whole = sums.groupBy("book", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    out = entries.copy()
    for row in whole.collect():
        out[row["book"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return out
