"""Helpers shared by the operators: Arrow text access and vectorised hashing.

Hashes are 64-bit polynomials modulo 2**64 over a fixed random byte table,
finished by a bit mixer. They are the same in every process and session.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 4 << 20  # text handled by one round of array operations; a longer text is one round

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def check_carried(keep: tuple[str, ...], own: tuple[str, ...]) -> None:
    """Carried columns must not have the name, in any case, of a column that an operator makes."""
    if clash := {k.lower() for k in keep} & {o.lower() for o in own}:
        raise ValueError(f"rename {sorted(clash)} before carrying them")


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the frame has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of the bytes in the given inclusive ranges."""
    member = np.zeros(256, bool)
    for low, high in ranges:
        member[low : high + 1] = True
    return member


def text_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 bounds of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(int(np.searchsorted(total, before + limit, "right")), start + 1)
            yield batch.slice(start, end - start)
            start = end


def released(run):
    """The batch function, giving freed memory back to the system at the end of each task.

    Python workers are used again by later stages, beside whatever they then need.
    """

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _release()  # a function of the module, so that what the driver has kept does not travel with this one

    return whole


def _release() -> None:
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


def powers(count: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    out = np.empty(count, np.uint64)
    if count:
        out[0] = 1
    done, step = 1, base
    while done < count:  # each round doubles the known part
        more = min(done, count - done)
        np.multiply(out[:more], np.uint64(step), out=out[done : done + more])
        done, step = done + more, step * step % (1 << 64)
    return out


_kept: dict[int, np.ndarray] = {}


def _powers(count: int, base: int) -> np.ndarray:
    known = _kept.get(base)
    if known is None or len(known) < count:
        known = powers(max(count, 1 << 16), base)
        if count <= 2 * CHUNK_BYTES:
            _kept[base] = known
    return known[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """Finish 64-bit values so that every bit depends on all of them."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end); equal bytes have equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data), _BASE), out=sums[1:])
    spans = (sums[ends] - sums[starts]) * _powers(len(data) + 1, _INVERSE)[starts]
    return mixed(spans ^ (np.asarray(ends - starts, np.uint64) << np.uint64(48)))


def gram_hashes(data: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """Hashes of all len(data) - width + 1 runs of ``width`` bytes; another odd ``base`` gives other ones."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    inverse = _INVERSE if base == _BASE else pow(base, -1, 1 << 64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data), base), out=sums[1:])
    spans = (sums[width:] - sums[:-width]) * _powers(len(data) - width + 1, inverse)
    return mixed(spans ^ np.uint64(width << 48))


def word_places(
    data: np.ndarray, bounds: np.ndarray, member: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows: maximal runs of member bytes, A-Z lower-cased first.

    Returns the hash, start and end byte of each word, and the n + 1 bounds of
    each row's words.
    """
    data = _LOWER[data]
    inside = member[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    starts = np.flatnonzero(inside & (first[:-1] | ~before[:-1]))
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    ends = np.flatnonzero(inside & (first[1:] | ~after[1:])) + 1
    return span_hashes(data, starts, ends), starts, ends, np.searchsorted(starts, bounds)


def words(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the n + 1 bounds of each row's words."""
    hashes, _, _, of = word_places(data, bounds, member)
    return hashes, of


class HashIndex:
    """Place of a 64-bit hash in a sorted array of distinct hashes, through slots by its leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.shift = np.uint64(64 - max(4, (4 * len(hashes)).bit_length()))
        at = (hashes >> self.shift).astype(np.int64)
        column = np.arange(len(at)) - np.searchsorted(at, at)
        shape = (int(column.max(initial=0)) + 1, 1 << (64 - int(self.shift)))
        self.hashes, self.places = np.zeros(shape, np.uint64), np.full(shape, -1, np.int32)
        self.hashes[column, at], self.places[column, at] = hashes, np.arange(len(hashes))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The places, -1 for hashes that are not there."""
        slot, out = (hashes >> self.shift).astype(np.int64), np.full(len(hashes), -1, np.int32)
        for known, places in zip(self.hashes, self.places, strict=True):
            np.copyto(out, places[slot], where=known[slot] == hashes)
        return out


def of_rows(bounds: np.ndarray) -> np.ndarray:
    """The row number of each element, given the rows' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
