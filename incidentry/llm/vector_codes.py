"""Vector codes: each part of a vector becomes the number of its codebook's nearest entry.

Codebooks are refined by rounds of assigning and averaging. Between rounds each
part keeps the numbers of its b nearest other entries, in order, a lower bound
of the distance to each, and one outer bound for all further entries. An entry
that moved by m lowers its bounds by m. The exact distance to the own entry then
tells how many of the bounds it does not lie under: none, and nothing else is
looked at; some, and those entries are measured; the outer one, and all are.
Bounds are rounded downwards and every comparison that they leave open is made
in integers, so the codes are those of a full search.

b is adapted to each part after each round: the least number with which all but
a sixteenth of the vectors would not have needed a full search.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentry.sources.workspace import discard, stage

from .common import check_carried, released
from .vectors import (
    SUMS, add_by_group, exact_squares, floored, matrices, moved, packed_column, sums_batch, unpacked,
)

BOUNDS = 16  # nearest entries kept at first
FULL_SHARE = 1 / 16  # of the vectors may need all distances before b grows
OWN = ("id", "point", "code", "near", "bound", "need", "error")


class Codes(NamedTuple):
    coded: DataFrame  # id, carried columns, code (one byte a part), error
    codebooks: DataFrame  # part, entry, components


class Kept(NamedTuple):
    """What one part of some vectors keeps: n, n x b, n x (b + 1), n."""

    code: np.ndarray
    near: np.ndarray  # -1 where fewer than b are known; the bound there is the outer one
    bound: np.ndarray  # the last one is the outer one
    need: np.ndarray  # bounds that did not settle the last round


def _below(values: np.ndarray) -> np.ndarray:
    """Single precision, never above the value."""
    with np.errstate(over="ignore"):
        small = values.astype(np.float32)
    return np.where(small > values, np.nextafter(small, np.float32(-np.inf)), small)


def _ordered(bounds: np.ndarray) -> np.ndarray:
    """Each bound lowered to those that follow it."""
    return np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]


def full_search(points: np.ndarray, entries: np.ndarray, b: int) -> Kept:
    """The nearest entry, of equally near ones the first, and bounds for the others."""
    squares, each, b_known = exact_squares(points, entries), np.arange(len(points)), min(b, len(entries) - 1)
    code = squares.argmin(1)
    squares[each, code] = np.iinfo(np.int64).max
    nearest = np.argpartition(squares, b_known - 1, axis=1)[:, :b_known] if b_known else np.zeros((len(points), 0), int)
    found = np.take_along_axis(squares, nearest, 1)
    order = np.lexsort((nearest, found), axis=-1)
    near = np.full((len(points), b), -1)
    near[:, :b_known] = np.take_along_axis(nearest, order, 1)
    np.put_along_axis(squares, nearest, np.iinfo(np.int64).max, 1)
    rest = squares.min(1)
    outer = np.where(rest == np.iinfo(np.int64).max, np.inf, np.sqrt(rest))
    bound = np.repeat(outer[:, None], b + 1, 1)
    bound[:, :b_known] = np.sqrt(np.take_along_axis(found, order, 1))
    return Kept(code, near, _below(np.nextafter(bound, -np.inf)), np.full(len(points), b + 1))


def resized(kept: Kept, b: int) -> Kept:
    """The same with b bounds and the outer one."""
    known = kept.near.shape[1]
    if b <= known:
        return kept._replace(near=kept.near[:, :b], bound=kept.bound[:, : b + 1])
    near = np.pad(kept.near, ((0, 0), (0, b - known)), constant_values=-1)
    return kept._replace(near=near, bound=np.pad(kept.bound, ((0, 0), (0, b - known)), mode="edge"))


def next_search(points: np.ndarray, entries: np.ndarray, steps: np.ndarray, kept: Kept) -> Kept:
    """What ``full_search`` would find for entries that have moved by at most ``steps`` since."""
    n, b = kept.near.shape
    own = ((points - entries[kept.code]) ** 2).sum(1)
    upper = np.nextafter(np.sqrt(own), np.inf)
    down = np.full((n, b + 1), steps.max(initial=0.0))
    down[:, :b] = np.where(kept.near < 0, down[:, :b], steps[kept.near])
    lower = _ordered(np.nextafter(kept.bound.astype(np.float64) - down, -np.inf))
    need = (lower <= upper[:, None]).sum(1)
    code, near, bound = kept.code.copy(), kept.near.copy(), _below(lower)
    some = np.flatnonzero((need > 0) & (need <= b))
    if len(some):
        unknown = np.iinfo(np.int64).max
        squares = np.full((len(some), b + 1), unknown)
        squares[:, 0] = own[some]
        numbers = np.concatenate([code[some, None], near[some]], 1)
        for z in range(int(need[some].max())):
            rows = np.flatnonzero(need[some] > z)
            squares[rows, z + 1] = ((points[some[rows]] - entries[numbers[rows, z + 1]]) ** 2).sum(1)
        # measured ones by distance and number, the others after them as they stood
        second = np.where(squares == unknown, len(entries) + np.arange(b + 1), numbers)
        order = np.lexsort((second, squares), axis=-1)
        numbers, squares = np.take_along_axis(numbers, order, 1), np.take_along_axis(squares, order, 1)
        code[some], near[some] = numbers[:, 0], numbers[:, 1:]
        measured = _below(np.nextafter(np.sqrt(squares[:, 1:].astype(np.float64)), -np.inf))
        bound[some, :b] = np.where(squares[:, 1:] == unknown, bound[some, :b], measured)
        bound[some] = _ordered(bound[some])
    full = np.flatnonzero(need > b)
    if len(full):
        again = full_search(points[full], entries, b)
        code[full], near[full], bound[full] = again.code, again.near, again.bound
    return Kept(code, near, bound, need)


def adapted(needs: np.ndarray, b: int, entries: int) -> int:
    """The next b, given how many vectors needed 0, 1, .. b, b + 1 bounds; twice as many if too many needed all."""
    if needs[b + 1] > needs.sum() * FULL_SHARE:
        return min(2 * b, max(entries // 4, 1))
    enough = int(np.searchsorted(np.cumsum(needs), needs.sum() * (1 - FULL_SHARE)))
    return max(min(enough, b), min(2, b))


class _Layout(NamedTuple):
    """Where the parts' bounds lie in the lists of a stored row."""

    sizes: tuple[int, ...]  # b of each part

    def split(self, matrix: np.ndarray, more: int) -> list[np.ndarray]:
        cuts = np.cumsum([b + more for b in self.sizes])
        return np.split(matrix, cuts[:-1], axis=1)

    def read(self, batch: pa.RecordBatch) -> list[Kept]:
        parts = len(self.sizes)
        code = unpacked(batch.column("code"), np.uint8).astype(np.int64)
        near = self.split(unpacked(batch.column("near"), np.int16).astype(np.int64), 0)
        bound = self.split(unpacked(batch.column("bound"), np.float32), 1)
        return [Kept(code[:, p], near[p], bound[p], code[:, p]) for p in range(parts)]


def _state_columns(kept: list[Kept]) -> list[pa.Array]:
    return [
        packed_column(np.stack([k.code for k in kept], 1), np.uint8),
        packed_column(np.concatenate([k.near for k in kept], 1), np.int16),
        packed_column(np.concatenate([k.bound for k in kept], 1), np.float32),
        packed_column(np.stack([k.need for k in kept], 1), np.int16),
    ]


def vector_codes(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (),
) -> Codes:
    """One code per vector, its squared error, and the codebooks after the rounds.

    Vectors that are null, empty, or hold null or non-finite components get no
    row, and neither do those whose length is not that of the vector with the
    least id or cannot be cut into equal parts. Codebooks start as the parts of
    the vectors with the least ids (null ids last, rows of one id by their
    components); fewer vectors make fewer entries, an empty table none and no
    rows. Repeated rows count, and are returned, as often as they stand.
    Components that exceed 2**27 when scaled, and columns to carry whose names
    are taken, are errors.

    Codebooks (at most 256 entries a part) are all that reaches the driver.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    check_carried(keep, OWN)
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).alias("id"), *[F.col(f"`{c}`") for c in keep], F.col(vector_col).cast("array<double>").alias("point")
    )
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    names = [f.name for f in rows.schema.fields[:-1]]
    far = F.lit(float("inf"))
    sound = F.forall("point", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < far)) & (F.size("point") > 0)
    first = rows.where(sound).orderBy(F.asc_nulls_last("id"), "point").limit(entries).select("point").collect()
    width = len(first[0]["point"]) if first else parts
    if width % parts:
        first = []
    seeds = np.array([r["point"] for r in first if len(r["point"]) == width]).reshape(-1, width)
    books = floored(seeds, scale).reshape(len(seeds), parts, width // parts).transpose(1, 0, 2)
    if not len(seeds):
        coded = spark.createDataFrame([], f"{carried}, code binary, error bigint")
        return Codes(coded, spark.createDataFrame([], "part int, entry int, components array<bigint>"))

    state_kind = f"{carried}, point binary, code binary, near binary, bound binary, need binary"
    layout = _Layout((min(BOUNDS, books.shape[1]),) * parts)
    state = stage(rows.mapInArrow(_starting(names, books, layout, scale), state_kind), "vector-bounds")
    for done in range(rounds):
        after, needs = _updated(state, books, layout)
        steps = np.nextafter(np.sqrt(((after - books) ** 2).sum(2).astype(np.float64)), np.inf)
        # in the first round every vector was searched in full, which says nothing of b
        sizes = layout.sizes if not done else tuple(
            adapted(n[: b + 2], b, books.shape[1]) for n, b in zip(needs, layout.sizes, strict=True)
        )
        books, before, layout = after, layout, _Layout(sizes)
        if done < rounds - 1:
            old, moving = state, _moving(names, books, steps, before, layout)
            state = stage(old.mapInArrow(moving, state_kind), "vector-bounds")
            discard(old)
        else:
            layout = before
    last = _coding(names, books, steps if rounds else np.zeros(books.shape[:2]), layout)
    coded = stage(state.mapInArrow(last, f"{carried}, code binary, error bigint"), "vector-codes")
    discard(state)
    listed = [(p, e, c) for p, book in enumerate(books.tolist()) for e, c in enumerate(book)]
    return Codes(coded, spark.createDataFrame(listed, "part int, entry int, components array<bigint>"))


def _starting(names: list[str], books: np.ndarray, layout: _Layout, scale: int):
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column("point"), 1 << 18):
                if matrix.shape[1] != parts * wide:
                    continue
                points = floored(matrix, scale)
                kept = [full_search(q, books[p], layout.sizes[p]) for p, q in enumerate(np.split(points, parts, 1))]
                some = batch.select(names).take(pa.array(at))
                columns = [*some.columns, packed_column(points, np.int32), *_state_columns(kept)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "point", "code", "near", "bound", "need"])

    return released(run)


def _rows(batches: Iterator[pa.RecordBatch], parts: int, wide: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    step = max((1 << 18) // (parts * wide), 1)
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            some = batch.slice(low, step)
            points = unpacked(some.column("point"), np.int32).astype(np.int64)
            yield some, np.split(points, parts, 1)


def _moving(names: list[str], books: np.ndarray, steps: np.ndarray, before: _Layout, layout: _Layout):
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, points in _rows(batches, parts, wide):
            kept = [
                next_search(points[p], books[p], steps[p], resized(k, layout.sizes[p]))
                for p, k in enumerate(before.read(some))
            ]
            columns = [*some.select([*names, "point"]).columns, *_state_columns(kept)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "point", "code", "near", "bound", "need"])

    return released(run)


def _coding(names: list[str], books: np.ndarray, steps: np.ndarray, layout: _Layout):
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, points in _rows(batches, parts, wide):
            codes, error = [], np.zeros(some.num_rows, np.int64)
            for p, k in enumerate(layout.read(some)):
                codes.append(next_search(points[p], books[p], steps[p], k).code)
                error += ((points[p] - books[p][codes[-1]]) ** 2).sum(1)
            code = packed_column(np.stack(codes, 1), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [*some.select(names).columns, code, pa.array(error)], [*names, "code", "error"]
            )

    return released(run)


def _updated(state: DataFrame, books: np.ndarray, layout: _Layout) -> tuple[np.ndarray, np.ndarray]:
    """The entries after averaging, and per part how many vectors needed 0, 1, .. bounds.

    The numbers needed travel as a book after the last one.
    """
    parts, count, wide = books.shape
    most = max(layout.sizes) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros_like(books), np.zeros((parts, count), np.int64)
        needs = np.zeros((parts, most), np.int64)
        for some, points in _rows(batches, parts, wide):
            code = unpacked(some.column("code"), np.uint8).astype(np.int64)
            need = unpacked(some.column("need"), np.int16).astype(np.int64)
            for p in range(parts):
                add_by_group(totals[p], counts[p], code[:, p], points[p])
                needs[p] += np.bincount(need[:, p], minlength=most)
        for p in range(parts):
            yield sums_batch(p, totals[p], counts[p])
        yield sums_batch(parts, needs.T, np.ones(most, np.int64))

    found = stage(state.mapInArrow(released(run), SUMS), "sums")
    after = moved(books, found.where(F.col("book") < parts))
    needs = np.zeros((parts, most), np.int64)
    for row in found.where(F.col("book") == parts).groupBy("entry", "place").agg(F.sum("total").alias("n")).collect():
        needs[row["place"], row["entry"]] = row["n"]
    discard(found)
    return after, needs
