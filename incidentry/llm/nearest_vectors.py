"""Exact nearest neighbours by a block matrix join.

Vectors are packed into blocks of rows, each vector also as int8 numbers with a
scale. Blocks of queries and of all rows meet in the cells of a grid, by an
equi-join on the cell. The product of two int8 blocks estimates all inner
products of a tile; the norms of what rounding took away bound the error. Pairs
whose upper bound reaches the k-th lower bound of their query survive, are
computed again from the original components, and go into heaps of k.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentry.sources.workspace import stage

from .common import released
from .vectors import matrices

BLOCK = 2048  # vectors of a block
QUERY_BLOCK = 512  # queries of a block
CELL_BLOCKS = 4  # blocks of either side that a cell of the grid holds on average
_EXACT = 1024  # int8 products of so many components add up exactly in single precision
_SLACK = 1e-14  # relative, per component; covers the rounding of scores and bounds themselves

_BLOCK_KIND = (
    "block bigint, width int, ids array<{kind}>, wanted array<boolean>, place array<int>, of array<bigint>, "
    "vectors binary, small binary, scale array<double>, size array<double>, lost array<double>"
)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of the vectors and of what rounding lost."""
    scale = np.maximum(np.abs(vectors).max(1) / 127, np.finfo(np.float64).tiny)
    small = np.rint(vectors / scale[:, None])
    lost = vectors - small * scale[:, None]
    return small.astype(np.int8), scale, np.sqrt((vectors**2).sum(1)), np.sqrt((lost**2).sum(1))


def int8_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of int8 rows, exact."""
    out = np.zeros((len(left), len(right)))
    for low in range(0, left.shape[1], _EXACT):
        some = slice(low, low + _EXACT)
        out += left[:, some].astype(np.float32) @ right[:, some].astype(np.float32).T
    return out


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner product of each row with its fellow, summed from the first component to the last."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


class _Block:
    """One row of a table of blocks as arrays."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, i: int):
        def numbers(name: str) -> np.ndarray:
            return rows.column(name)[i].values.to_numpy(zero_copy_only=False)

        self.width, self.number = rows.column("width")[i].as_py(), rows.column("block")[i].as_py()
        self.ids, self.wanted = rows.column("ids")[i].values, numbers("wanted").astype(bool)
        self.of, self.place = numbers("of"), numbers("place")
        self.scale, self.size, self.lost = numbers("scale"), numbers("size"), numbers("lost")
        self.vectors = np.frombuffer(rows.column("vectors")[i].as_py()).reshape(-1, self.width)
        self.small = np.frombuffer(rows.column("small")[i].as_py(), np.int8).reshape(-1, self.width)

    def some(self, at: np.ndarray) -> _Block:
        """The chosen vectors."""
        out = copy.copy(self)
        for name in ("wanted", "of", "place", "scale", "size", "lost", "vectors", "small"):
            setattr(out, name, getattr(self, name)[at])
        out.ids = self.ids.take(pa.array(at))
        return out


def tile(queries: _Block, rows: _Block, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, score) of the pairs that can be among the k nearest of their query.

    ``least`` is a score that k other rows are known to reach, per query; -inf without one.
    """
    estimate = int8_products(queries.small, rows.small) * queries.scale[:, None] * rows.scale[None, :]
    # x.y = x'.y' + x'.e + d.y, with x' the rounded query, d and e what rounding lost of x and y
    error = (queries.size + queries.lost)[:, None] * rows.lost[None, :] + queries.lost[:, None] * rows.size[None, :]
    error += _SLACK * queries.width * queries.size[:, None] * rows.size[None, :]
    own = (queries.of[:, None] == rows.of[None, :]) & (queries.place[:, None] == rows.place[None, :])
    lower = np.where(own, -np.inf, estimate - error)
    if lower.shape[1] >= k:
        least = np.maximum(least, np.partition(lower, lower.shape[1] - k, axis=1)[:, -k])
    query, row = np.nonzero((estimate + error >= least[:, None]) & ~own)
    score = np.empty(len(query))
    for low in range(0, len(query), 1 << 15):
        some = slice(low, low + (1 << 15))
        score[some] = inner_products(queries.vectors[query[some]], rows.vectors[row[some]])
    return query, row, score


def _order(entry: tuple) -> tuple:
    score, vec = entry
    return -score, vec is None, 0 if vec is None else vec


def nearest_vectors(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k rows of largest inner product for each query row: (query_id, rank, vec_id, score).

    ``queries`` is a condition that tells which rows are queries; a null
    counts as no. A query's candidates are all rows but itself, also rows that repeat it or
    its id; with fewer than k, all are returned. Ties go to the smaller id, null
    ids last. A query row that stands twice is answered twice. Vectors that are
    null, empty, zero or hold null or non-finite components take no part, and
    vectors of different lengths do not meet. An empty table gives no rows. The
    result is exact; scores are sums in double precision from the first
    component to the last.

    A cell of the grid holds some blocks of either side, however large the
    table or common an id; each row is sent to as many cells as there are
    groups of query blocks.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).alias("id"), F.coalesce(queries, F.lit(False)).alias("wanted"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    name = rows.schema["id"].dataType.simpleString()
    block_kind = _BLOCK_KIND.format(kind=name)
    blocks = stage(rows.mapInArrow(released(_packing(block)), block_kind), "vector-blocks")
    wanted = stage(blocks.mapInArrow(released(_gathering(block, query_block)), block_kind), "query-blocks")
    across = max(math.ceil(blocks.count() / CELL_BLOCKS), 1)
    down = max(math.ceil(wanted.count() / CELL_BLOCKS), 1)

    def dealt(side: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        """Each block with its own number in the grid, once for each number of the other side."""
        own_number = F.pmod(F.xxhash64("block"), F.lit(own_count)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(other_count - 1)))
        return side.select("*", own_number.alias(own)).select("*", every.alias(other))

    cell = ["across", "down"]
    side = dealt(wanted, "down", down, "across", across).groupBy(*cell)
    found = side.cogroup(dealt(blocks, "across", across, "down", down).groupBy(*cell)).applyInArrow(
        _searching(k), f"of bigint, place int, query_id {name}, ids array<{name}>, scores array<double>"
    )
    merged = found.repartition("of", "place").sortWithinPartitions("of", "place")
    return merged.mapInArrow(_merging(k), f"query_id {name}, rank int, vec_id {name}, score double")


def _packing(size: int):
    """Blocks of the usable vectors of a task, in the order of its rows, numbered within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, tuple] = {}  # by length: ids, marks, matrix
        for batch in batches:
            for at, matrix in matrices(batch.column("vector")):
                used = np.flatnonzero(matrix.any(1))
                rows = batch.take(pa.array(at[used]))
                marks = rows.column("wanted").to_numpy(zero_copy_only=False).astype(bool)
                held, width = (rows.column("id"), marks, matrix[used]), matrix.shape[1]
                if width in waiting:
                    held = _joined(waiting[width], held)
                while len(held[1]) >= size:
                    yield _block(number, *[h[:size] for h in held])
                    number, held = number + 1, tuple(h[size:] for h in held)
                waiting[width] = held
        for held in waiting.values():
            if len(held[1]):
                yield _block(number, *held)
                number += 1

    return run


def _joined(first: tuple, second: tuple) -> tuple:
    return pa.concat_arrays([first[0], second[0]]), *(np.concatenate(p) for p in zip(first[1:], second[1:], strict=True))


def _block(number: int, ids: pa.Array, marks: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    small, scale, size, lost = quantised(matrix)
    place = np.arange(len(ids), dtype=np.int32)
    of = np.full(len(ids), number, np.int64)
    return _stored(number, matrix.shape[1], ids, [marks, place, of], [matrix, small], [scale, size, lost])


_NAMES = ["block", "width", "ids", "wanted", "place", "of", "vectors", "small", "scale", "size", "lost"]


def _stored(number: int, width: int, ids: pa.Array, marks: list, rows: list, norms: list) -> pa.RecordBatch:
    def one(values) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))

    columns = [pa.array([number], pa.int64()), pa.array([width], pa.int32()), one(ids), *map(one, marks)]
    columns += [pa.array([np.ascontiguousarray(r).tobytes()], pa.binary()) for r in rows]
    return pa.RecordBatch.from_arrays([*columns, *map(one, norms)], _NAMES)


def _gathering(block_size: int, size: int):
    """The marked vectors of a task's blocks as blocks of their own, numbered by their first vector."""

    def gathered(held: list[_Block]) -> pa.RecordBatch:
        def all_of(name: str) -> np.ndarray:
            return np.concatenate([getattr(h, name) for h in held])

        number = int(held[0].of[0]) * block_size + int(held[0].place[0])
        return _stored(
            number, held[0].width, pa.concat_arrays([h.ids for h in held]), [all_of("wanted"), all_of("place"), all_of("of")],
            [all_of("vectors"), all_of("small")], [all_of("scale"), all_of("size"), all_of("lost")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[_Block]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i)
                chosen = np.flatnonzero(block.wanted)
                for low in range(0, len(chosen), size):
                    part = block.some(chosen[low : low + size])
                    held = waiting.setdefault(block.width, [])
                    if sum(len(h.of) for h in held) + len(part.of) > size:
                        yield gathered(held)
                        held.clear()
                    held.append(part)
        for held in waiting.values():
            if held:
                yield gathered(held)

    return run


def _searching(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        blocks = [_Block(rows, i) for i in range(rows.num_rows)]
        for i in range(queries.num_rows):
            wanted = _Block(queries, i)
            heaps: list[list] = [[] for _ in wanted.of]
            for block in blocks:
                if block.width == wanted.width:
                    _into_heaps(heaps, wanted, block, k)
            found.append(_best(wanted, heaps, queries.schema.field("ids").type))
        return pa.Table.from_batches(found) if found else _best_of_none(queries.schema.field("ids").type)

    return run


def _into_heaps(heaps: list[list], queries: _Block, block: _Block, k: int) -> None:
    least = np.array([h[-1][0] if len(h) == k else -np.inf for h in heaps])
    query, row, score = tile(queries, block, k, least)
    ids = block.ids.take(pa.array(row)).to_pylist()
    cuts = np.searchsorted(query, np.arange(len(heaps) + 1))
    for q, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if low < high:
            new = [(float(score[j]), ids[j]) for j in range(low, high)]
            heaps[q] = heapq.nsmallest(k, heaps[q] + new, key=_order)


_BEST = ["of", "place", "query_id", "ids", "scores"]


def _best(queries: _Block, heaps: list[list], listed: pa.DataType) -> pa.RecordBatch:
    held = np.array([q for q, h in enumerate(heaps) if h], np.int64)
    columns = [
        pa.array(queries.of[held]), pa.array(queries.place[held]), queries.ids.take(pa.array(held)),
        pa.array([[v for _, v in heaps[q]] for q in held], listed),
        pa.array([[s for s, _ in heaps[q]] for q in held], pa.list_(pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(columns, _BEST)


def _best_of_none(listed: pa.DataType) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), listed.value_type, listed, pa.list_(pa.float64())]
    return pa.Table.from_arrays([pa.array([], kind) for kind in kinds], _BEST)


def _merging(k: int):
    """Rows of one query follow each other; one heap is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, heap, kind = None, None, [], None
        for batch in batches:
            out, kind = [], batch.schema.field("query_id").type
            for row in batch.to_pylist():
                if (row["of"], row["place"]) != key:
                    out += _ranked(query, heap)
                    key, query, heap = (row["of"], row["place"]), row["query_id"], []
                heap = heapq.nsmallest(k, heap + list(zip(row["scores"], row["ids"], strict=True)), key=_order)
            yield _answers(out, kind)
        if heap:
            yield _answers(_ranked(query, heap), kind)

    return run


def _ranked(query, heap: list) -> list[tuple]:
    return [(query, rank, vec, score) for rank, (score, vec) in enumerate(heap, 1)]


def _answers(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    query, rank, vec, score = zip(*rows, strict=True) if rows else ((), (), (), ())
    columns = [pa.array(query, kind), pa.array(rank, pa.int32()), pa.array(vec, kind), pa.array(score, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, ["query_id", "rank", "vec_id", "score"])
