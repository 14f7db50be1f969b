"""Removal of long repeated substrings with merged Burrows-Wheeler transforms.

Every string of ``LENGTH`` bytes holds a selected 32-byte gram (the one of least
hash in it), so equal strings hold equal anchors at equal places. Anchors that
occur once are dropped; around the others the contexts are cut out, all strings
of which the anchor is the selected gram, and contexts of one anchor meet in one
task. There each shard of contexts has a Burrows-Wheeler transform over 25-byte
symbols, and the shards' transforms are merged by refining their interleave, one
symbol deeper a round. Rows that no round has parted have a common prefix of
``LENGTH`` bytes: a repeated interval, whose earliest place stays.

Anchors with very many different contexts, such as those at the edge of a
passage that stands in many documents, go another, equally exact way: their strings are
aggregated one by one. They are told by counts before contexts are dealt out by anchor. Documents of the same text are worked on once.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentry.sources.workspace import stage

from .common import check_carried, gram_hashes, mixed, of_rows, pieces, released, span_hashes, text_of

LENGTH = 100
GRAM = 32
STRIDE = 25  # bytes of a symbol; LENGTH is a multiple
SHARD_BYTES = 60_000  # so that a shard's suffixes, end marks included, have numbers below 2**16
PIECE_BYTES = 1 << 19  # text whose anchors are found at once
MERGED_BYTES = 1 << 19  # contexts merged at once, whole anchors
HOT_CONTEXTS = 2000
BUCKETS = 64
BUCKET_BYTES = 64 << 20  # text for each bucket of anchors, which one task holds whole
GATHERED = 1 << 18  # anchors of a task that are packed together
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # of the two hashes of a string
_FACTOR = 0xA0761D6478BD642F
_LAST = (1 << 63) - 1


def text_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's bytes and their number."""
    line = span_hashes(data, bounds[:-1], bounds[1:])
    return mixed(line + np.diff(bounds).astype(np.uint64) * np.uint64(_FACTOR)).view(np.int64)


def anchors(data: np.ndarray, bounds: np.ndarray):
    """Selected grams of all rows: place, hash, and the first and last string that each is selected for."""
    n = len(data)
    strings = n - LENGTH + 1
    nothing = np.zeros(0, np.int64)
    if strings < 1:
        return nothing, nothing.view(np.uint64), nothing, nothing
    grams = gram_hashes(data, GRAM)
    mask = np.uint64((1 << n.bit_length()) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)  # the leftmost of equal ones
    wide, covered = LENGTH - GRAM + 1, 1
    while covered < wide:
        step = min(covered, wide - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    change = np.zeros(n + 2, np.int32)
    long = np.diff(bounds) >= LENGTH
    np.add.at(change, bounds[:-1][long], 1)
    np.add.at(change, bounds[1:][long] - LENGTH + 1, -1)
    string = np.flatnonzero(np.cumsum(change[:strings]) > 0)
    if not len(string):
        return nothing, nothing.view(np.uint64), nothing, nothing
    place = (least[string] & mask).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    return place[first], grams[place[first]], string[first], string[last]


def _keyed(rows: DataFrame) -> DataFrame:
    """(id, node, text): node is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            node = text_hashes(*text_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(node), batch.column("text")], ["id", "node", "text"]
            )

    return rows.mapInArrow(released(run), "id bigint, node bigint, text string")


_PACKED = ["bucket", "hashes", "places", "nodes", "counts"]


def _dealt_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """Every task's anchors, packed by bucket, each distinct text once.

    Anchors are gathered over texts, up to ``GATHERED``, so that a row holds many whatever the number
    of buckets. Two of a gram show its bucket that it is repeated; further ones, known to be so, go
    by a bucket of their own, a negative one, that gathers nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple] = []
        for batch in pieces(batches, "text", PIECE_BYTES):
            data, bounds = text_of(batch.column("text"))
            nodes = text_hashes(data, bounds)
            fresh = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes.tolist()):
                fresh[i] = node not in seen
                seen.add(node)
            place, grams, _, _ = anchors(data, bounds)
            row = np.searchsorted(bounds, place, "right") - 1
            keep = fresh[row]
            held.append((grams[keep], (place[keep] - bounds[:-1][row[keep]]).astype(np.int32), nodes[row[keep]]))
            if sum(len(h[0]) for h in held) >= GATHERED:
                yield _packed_anchors(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)
                held = []
        if held:
            yield _packed_anchors(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)

    return rows.mapInArrow(released(run), "bucket int, hashes binary, places binary, nodes binary, counts binary")


def _packed_anchors(grams: np.ndarray, place: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket, a range of the leading 32 bits; the anchors of a text follow each other in it.

    Anchors have the least hashes of their strings, so hashes are mixed once more: as they are, half of all anchors
    would be in the lowest of 64 buckets.
    """
    grams = mixed(grams)
    bucket = (((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    alike = np.argsort(grams, kind="stable")
    further = alike[2:][grams[alike[2:]] == grams[alike[:-2]]]
    bucket[further] = -1 - (node[further] % buckets).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    place, grams, node, bucket = place[by], grams[by], node[by], bucket[by]
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(by) else np.zeros(1, int)
    out: list[list] = [[] for _ in _PACKED]
    for a, b in zip(cut, cut[1:], strict=False):
        of = np.flatnonzero(np.r_[True, node[a + 1 : b] != node[a : b - 1], True])
        packed = (
            np.ascontiguousarray(grams[a:b].view(np.uint8).reshape(-1, 8)[:, :6]),  # the other bits tell the bucket
            place[a:b], node[a + of[:-1]], np.diff(of).astype(np.int32),
        )
        for column, value in zip(out, (int(bucket[a]), *(x.tobytes() for x in packed)), strict=True):
            column.append(value)
    kinds = (pa.int32(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _PACKED)


def _repeated_anchors(packed: DataFrame, buckets: int) -> DataFrame:
    """(node, place) of every anchor whose gram stands at two places or more, of distinct texts.

    A text that several tasks hold may come with a place more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            for part in batch.to_pylist():
                if part["bucket"] < 0:
                    yield _anchor_places(part)
                    continue
                if part["bucket"] != current and parts:
                    yield from _repeated(parts)
                    parts = []
                current = part["bucket"]
                parts.append(part)
        if parts:
            yield from _repeated(parts)

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(released(run), "node bigint, place int")


def _anchor_places(part: dict) -> pa.RecordBatch:
    nodes = np.frombuffer(part["nodes"], np.int64)
    node = np.repeat(nodes, np.frombuffer(part["counts"], np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(np.frombuffer(part["places"], np.int32))], ["node", "place"]
    )


def _repeated(parts: list[dict]) -> Iterator[pa.RecordBatch]:
    def joined(name, kind):
        return np.concatenate([np.frombuffer(p[name], kind) for p in parts])

    raw = joined("hashes", np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :6] = raw
    values = wide.view(np.uint64)[:, 0]
    by = np.argsort(values)
    values = values[by]
    twice = np.r_[False, values[1:] == values[:-1]]
    twice[:-1] |= twice[1:]
    values, by = values[twice], by[twice]
    node = np.repeat(joined("nodes", np.int64), joined("counts", np.int32))[by]
    place = joined("places", np.int32)[by]
    by = np.lexsort((place, node, values))
    values, node, place = values[by], node[by], place[by]
    if len(by):
        new = np.r_[True, (values[1:] != values[:-1]) | (node[1:] != node[:-1]) | (place[1:] != place[:-1])]
        values, node, place = values[new], node[new], place[new]
        twice = np.r_[False, values[1:] == values[:-1]]
        twice[:-1] |= twice[1:]
        node, place = node[twice], place[twice]
    for a in range(0, len(node), 100_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[a : a + 100_000]), pa.array(place[a : a + 100_000])], ["node", "place"]
        )


_CONTEXTS = "anchor bigint, key bigint, content binary, id bigint, node bigint, start int"


def _contexts(rows: DataFrame) -> DataFrame:
    """The contexts around the repeated anchors (``places``) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            data, bounds = text_of(batch.column("text"))
            place, grams, first, last = anchors(data, bounds)
            row = np.searchsorted(bounds, place, "right") - 1
            lists = batch.column("places")
            known = lists.flatten().to_numpy().astype(np.int64)
            of = of_rows(lists.offsets.to_numpy() - lists.offsets[0].as_py())
            repeated = np.isin(place, known + bounds[:-1][of])
            low, high, pick = first, last, np.flatnonzero(repeated)
            raw = data.tobytes()
            base = bounds[:-1][row[pick]]
            contents = [raw[a : b + LENGTH] for a, b in zip(low[pick].tolist(), high[pick].tolist(), strict=True)]
            # The selected gram's place belongs to the key: equal strings have it at equal places.
            keys = span_hashes(data, low[pick], high[pick] + LENGTH)
            keys = mixed(keys + (place[pick] - low[pick]).astype(np.uint64) * np.uint64(_FACTOR)).view(np.int64)
            ids = batch.column("id").to_numpy()[row[pick]]
            nodes = batch.column("node").to_numpy()[row[pick]]
            for a in range(0, len(pick), 20_000):
                b = a + 20_000
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[pick[a:b]].view(np.int64)), pa.array(keys[a:b]),
                        pa.array(contents[a:b], pa.binary()), pa.array(ids[a:b]), pa.array(nodes[a:b]),
                        pa.array((low[pick] - base)[a:b].astype(np.int32)),
                    ],
                    ["anchor", "key", "content", "id", "node", "start"],
                )

    return rows.mapInArrow(released(run), _CONTEXTS)


def stable_order(number: np.ndarray) -> np.ndarray:
    """Order of numbers below 2**32, equal ones as they stood: two passes over 16 bits, which numpy sorts by radix."""
    by = np.argsort((number & 0xFFFF).astype(np.uint16), kind="stable")
    if len(number) and int(number.max()) >> 16:
        by = by[np.argsort((number[by] >> 16).astype(np.uint16), kind="stable")]
    return by


def numbered(values: np.ndarray) -> np.ndarray:
    """The place of each value among the distinct ones."""
    if len(values) and int(values.max()) >> 32:
        return np.unique(values, return_inverse=True)[1].astype(np.int64)
    by = stable_order(values)
    out = np.empty(len(values), np.int64)
    out[by] = np.cumsum(np.r_[False, np.diff(values[by]) != 0]) if len(by) else by
    return out


class ShardTransform:
    """Suffixes of a shard's contexts in order, and the symbol before each.

    The bytes at a distance of ``STRIDE`` form chains; a suffix is a chain's rest
    and an end mark. Symbols are hashes of ``STRIDE`` bytes, 0 is the mark.
    ``order`` numbers the places: a place of the text, or the text's length and
    beyond for the suffixes that are an end mark only.
    """

    def __init__(self, symbol: np.ndarray, follows: np.ndarray, longest: int):
        """``follows``: the place of the next suffix of the chain; ``longest``: symbols of the longest one."""
        n = len(symbol)
        marks = len(follows) - n
        whole = np.concatenate([symbol, np.zeros(marks, np.uint64)])
        rank = np.unique(whole, return_inverse=True)[1].astype(np.int64)
        step = follows
        for _ in range(int(longest - 1).bit_length()):  # by twice as many symbols a round
            rank = numbered(rank << 16 | rank[step] if len(rank) < 1 << 16 else rank << 32 | rank[step])
            step = step[step]
        # End marks are ordered by their chain, and so are suffixes that tie to their ends.
        self.order = stable_order(rank)
        before = np.zeros(len(whole), np.uint64)
        before[follows[:n]] = symbol
        self.before = before[self.order]
        self.marks = marks


def merge_transforms(shards: list[ShardTransform]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge by interleave refinement: the shard and row of each merged suffix, and its interval.

    The interleave lists the shard of each row. A round deals its entries out by
    the symbols before their suffixes, stably, which orders it one symbol deeper;
    the end marks keep their places, shard by shard. Intervals that a round does
    not part have one symbol more in common. No suffix is compared again.
    """
    sizes = np.array([len(s.order) for s in shards])
    marks = np.array([s.marks for s in shards])
    offset = np.cumsum(sizes) - sizes
    # symbols by number: the end mark stays 0, as it is the least
    before = np.unique(np.concatenate([[np.uint64(0)], *[s.before for s in shards]]), return_inverse=True)[1][1:]
    of = np.repeat(np.arange(len(shards), dtype=np.int16), sizes)
    total = len(of)
    n_marks = int(marks.sum())
    # rows of end marks stand first in every shard; start with all rows, shard by shard
    interval = np.zeros(total, np.int64)
    mark_rows = np.repeat(np.arange(len(shards), dtype=np.int16), marks)
    for _ in range(LENGTH // STRIDE):
        row = np.empty(total, np.int64)
        row[np.argsort(of, kind="stable")] = np.arange(total)  # the next row of its shard
        symbol = before[row]
        moving = np.flatnonzero(symbol != 0)
        by = moving[stable_order(symbol[moving])]
        new = np.r_[True, (np.diff(symbol[by]) != 0) | (np.diff(interval[by]) != 0)] if len(by) else np.zeros(0, bool)
        of = np.concatenate([mark_rows, of[by]])
        interval = np.concatenate([np.zeros(n_marks, np.int64), np.cumsum(new)])
    row = np.empty(total, np.int64)
    row[np.argsort(of, kind="stable")] = np.arange(total)
    return of, row - offset[of], interval


def repeated_strings(contents: list[bytes], ids: np.ndarray, starts: np.ndarray):
    """Earliest place of every string of the contexts.

    Returns the context and place of each string, and the id and start of the
    earliest equal one; a context's own ``(id, start)`` is its earliest place.
    """
    lengths = np.array([len(c) for c in contents])
    shard_of = (np.cumsum(lengths) - lengths) // SHARD_BYTES
    shards, numbers, places = [], [], []
    for shard in np.unique(shard_of):
        pick = np.flatnonzero(shard_of == shard)
        data = np.frombuffer(b"".join(contents[i] for i in pick), np.uint8)
        size = lengths[pick]
        bounds = np.r_[0, np.cumsum(size)]
        row = of_rows(bounds)
        at = np.arange(len(data)) - bounds[:-1][row]
        whole = at + STRIDE <= size[row]  # a symbol begins here
        place = np.flatnonzero(whole)
        symbol = gram_hashes(data, STRIDE)[place] | np.uint64(1)
        index = np.full(len(data) + STRIDE, -1, np.int64)
        index[place] = np.arange(len(place))
        following = index[place + STRIDE]
        same = place + STRIDE < bounds[1:][row[place]]
        ends = np.flatnonzero((following < 0) | ~same)
        following[ends] = len(place) + np.arange(len(ends))
        marks = len(place) + np.arange(len(ends))
        shards.append(ShardTransform(symbol, np.r_[following, marks], int(size.max()) // STRIDE + 1))
        numbers.append(np.r_[pick[row[place]], np.full(len(ends), -1)])
        places.append(np.r_[at[place], np.full(len(ends), -1)])
    of, row, interval = merge_transforms(shards)
    sizes = np.array([len(s.order) for s in shards])
    offset = np.cumsum(sizes) - sizes
    suffix = np.concatenate([s.order + o for s, o in zip(shards, offset, strict=True)])[offset[of] + row]
    context, place = np.concatenate(numbers)[suffix], np.concatenate(places)[suffix]
    string = (context >= 0) & (place + LENGTH <= lengths[context])
    context, place, interval = context[string], place[string], interval[string]
    at_id, at_start = ids[context], starts[context] + place
    if not len(interval):
        return context, place, at_id, at_start
    first = np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]])  # equal strings follow each other
    size = np.diff(np.r_[first, len(interval)])
    least_id = np.repeat(np.minimum.reduceat(at_id, first), size)
    there = np.where(at_id == least_id, at_start, np.iinfo(at_start.dtype).max)
    return context, place, least_id, np.repeat(np.minimum.reduceat(there, first), size)


_EARLIEST = "anchor bigint, key bigint, place int, n int, first_id bigint, first_start int"
_DISTINCT = "anchor bigint, key bigint, content binary, id bigint, start int, copies bigint"


def _combined(occurrences: DataFrame) -> DataFrame:
    """The contexts of each batch once, with the earliest place and the number of occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("anchor", "key", "id", "start")]
            order, first, copies = _grouped(*columns, np.ones(batch.num_rows, np.int64))
            kept = batch.take(pa.array(order[first]))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(c) for c in ("anchor", "key", "content", "id", "start")), pa.array(copies)],
                ["anchor", "key", "content", "id", "start", "copies"],
            )

    return occurrences.drop("node").mapInArrow(released(run), _DISTINCT)


def _grouped(anchor, key, at_id, start, copies) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by context and place, the first of each context in it, and its occurrences."""
    order = np.lexsort((start, at_id, key, anchor))
    anchor, key = anchor[order], key[order]
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])]) if len(order) else order
    return order, first, np.add.reduceat(copies[order], first) if len(order) else copies


def _batch(anchor, key, place, n, first_id, first_start) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor, pa.int64()), pa.array(key, pa.int64()), pa.array(place, pa.int32()),
            pa.array(n, pa.int32()), pa.array(first_id, pa.int64()), pa.array(first_start, pa.int32()),
        ],
        ["anchor", "key", "place", "n", "first_id", "first_start"],
    )


def _merged(contexts: DataFrame) -> DataFrame:
    """Earliest places in the contexts of each anchor, as runs of strings whose places follow each other.

    An anchor has at most ``HOT_CONTEXTS`` rows here, so the group that one task holds is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            if rest is not None:
                some = pa.concat_tables([rest, some])
            anchor = some.column("anchor").to_numpy()
            last = int(np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])[-1])
            rest = some.slice(last)  # may go on in the next batch
            if last:
                yield from _merged_anchors(some.slice(0, last))
        if rest is not None and rest.num_rows:
            yield from _merged_anchors(rest)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(released(run), _EARLIEST)


def _merged_anchors(some: pa.Table) -> Iterator[pa.RecordBatch]:
    columns = [some.column(c).to_numpy() for c in ("anchor", "key", "id", "start", "copies")]
    order, first, copies = _grouped(*columns)
    kept = order[first]
    anchor, key, at_id, start = (c[kept] for c in columns[:4])
    contents = some.column("content").take(pa.array(kept)).to_pylist()
    strings = np.array([len(c) - LENGTH + 1 for c in contents])
    of = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
    size = np.repeat(np.diff(of), np.diff(of))
    # One context: nothing to merge, and no repeat unless it stands at several places.
    alike = np.flatnonzero((size == 1) & (copies > 1))
    yield _batch(anchor[alike], key[alike], np.zeros(len(alike)), strings[alike], at_id[alike], start[alike])
    merged = np.flatnonzero(size > 1)
    filled = np.cumsum(strings[merged] + LENGTH - 1) // MERGED_BYTES
    new = np.r_[True, anchor[merged][1:] != anchor[merged][:-1]] if len(merged) else np.zeros(0, bool)
    block = filled[new][np.cumsum(new) - 1] if len(merged) else filled  # an anchor is in one block
    for number in np.unique(block):
        pick = merged[block == number]
        found = repeated_strings([contents[i] for i in pick.tolist()], at_id[pick], start[pick])
        yield from _earliest_runs(anchor[pick], key[pick], *found, copies[pick] == 1, (at_id[pick], start[pick]))


def _earliest_runs(anchor, key, context, place, first_id, first_start, alone, own) -> Iterator[pa.RecordBatch]:
    """Strings of a context that stands in one place only, which is their earliest, are left out."""
    kept = ~(alone[context] & (first_id == own[0][context]) & (first_start == own[1][context] + place))
    context, place, first_id, first_start = (x[kept] for x in (context, place, first_id, first_start))
    by = np.argsort(context << 32 | place)
    context, place, first_id, first_start = (x[by] for x in (context, place, first_id, first_start))
    if not len(by):
        return
    new = np.r_[
        True,
        (np.diff(context) != 0) | (np.diff(place) != 1) | (np.diff(first_id) != 0) | (np.diff(first_start) != 1),
    ]
    at = np.flatnonzero(new)
    n = np.diff(np.r_[at, len(by)])
    yield _batch(anchor[context[at]], key[context[at]], place[at], n, first_id[at], first_start[at])


def _one_by_one(contexts: DataFrame) -> DataFrame:
    """The same for contexts of hot anchors: every string by two hashes of it, earliest by an aggregate.

    Strings that stand in one place only are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 5_000):
                some = batch.slice(low, 5_000)
                contents = some.column("content").cast(pa.large_binary())
                bounds = np.frombuffer(contents.buffers()[1], np.int64)[contents.offset :][: len(contents) + 1]
                data = np.frombuffer(contents.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
                bounds = bounds - bounds[0]
                strings = np.diff(bounds) - LENGTH + 1
                row = np.repeat(np.arange(len(strings)), strings)
                place = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
                at = bounds[:-1][row] + place
                hashes = [gram_hashes(data, LENGTH, base)[at].view(np.int64) for base in _BASES]
                of_row = some.take(pa.array(row))
                start = of_row.column("start").to_numpy() + place
                yield pa.RecordBatch.from_arrays(
                    [
                        *map(pa.array, hashes), of_row.column("anchor"), of_row.column("key"), pa.array(place.astype(np.int32)),
                        of_row.column("id"), pa.array(start.astype(np.int32)), of_row.column("copies"),
                    ],
                    ["h1", "h2", "anchor", "key", "place", "id", "start", "copies"],
                )

    strings = contexts.select("anchor", "key", "content", "id", "start", "copies").mapInArrow(
        released(run), "h1 bigint, h2 bigint, anchor bigint, key bigint, place int, id bigint, start int, copies bigint"
    )
    earliest = strings.groupBy("h1", "h2").agg(
        F.min(F.struct("id", "start")).alias("first"), F.sum("copies").alias("copies")
    ).where("copies > 1").drop("copies")
    return strings.join(earliest, ["h1", "h2"]).select(
        "anchor", "key", "place", F.lit(1).alias("n"), F.col("first.id").alias("first_id"),
        F.col("first.start").alias("first_start"),
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    """Stage a frame and let Spark's cleaner drop the shuffle files of the steps before."""
    out = stage(df, label)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def _occurrences(keyed: DataFrame, firsts: DataFrame, buckets: int, rows: DataFrame | None = None) -> DataFrame:
    """The contexts of all texts, each text once, under its least id; ``rows`` are the texts before they were keyed."""
    texts = (keyed if rows is None else rows).select("text")
    places = (
        _repeated_anchors(_dealt_anchors(texts, buckets), buckets)
        .groupBy("node").agg(F.collect_set("place").alias("places"))
    )
    holders = keyed.join(places.join(firsts, "node"), "node").where("id = first")
    return _contexts(holders.select("id", "node", "text", "places"))


def _parted(occurrences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contexts of anchors with at most ``HOT_CONTEXTS`` different ones, and those of hot anchors.

    Different contexts are counted by anchor and key, which combines before the shuffle, so no anchor's rows
    meet in a task. The few hot anchors then label the contexts, in one join.
    """
    different = occurrences.groupBy("anchor", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = stage(
        different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_CONTEXTS)
        .select("anchor", F.lit(True).alias("hot")),
        "hot-anchors",
    )
    labelled = occurrences.join(hot, "anchor", "left")
    distinct = stage(
        _combined(labelled.where("hot").drop("hot"))
        .groupBy("anchor", "key")
        .agg(F.min(F.struct("id", "start", "content")).alias("least"), F.sum("copies").alias("copies"))
        .select("anchor", "key", "least.content", "least.id", "least.start", "copies"),
        "hot-contexts",
    )
    return _combined(labelled.where("hot IS NULL").drop("hot")), distinct


def repeated_runs(occurrences: DataFrame) -> DataFrame:
    """(node, start, n, first_id, first_start): runs of n strings of each text and their earliest places."""
    few, hot = _parted(occurrences)
    earliest = _written(_merged(few), "earliest").union(_one_by_one(hot))
    return occurrences.select("anchor", "key", "node", F.col("start").alias("at")).join(
        earliest, ["anchor", "key"]
    ).select("node", (F.col("at") + F.col("place")).alias("start"), "n", "first_id", "first_start")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row (id, kept, n_bytes, spans, kept_text) per document, repeated rows included.

    ``kept`` are the UTF-8 bytes that no string of ``LENGTH`` bytes covers which
    stands earlier too: in a document with a smaller id, or before it in the
    same one. ``spans`` are the removed runs as (start, end), ``kept_text`` is
    what is left without the rest of characters that a cut splits. Ids are integers;
    rows with a null id come after all others. Rows that share an id are one
    document: at the same start neither is the earlier. Null texts are empty.
    ``keep`` names columns to carry, a ValueError where they clash with these.
    Texts are told apart by a 64-bit hash.
    """
    check_carried(keep, ("id", "kept", "n_bytes", "spans", "kept_text", "__id", "__text", "__node", "__first", "__runs"))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    keyed = _keyed(rows)
    measured = stage(keyed.select("id", "node", F.octet_length("text").alias("n")), "text-hashes")
    firsts = measured.groupBy("node").agg(F.min("id").alias("first"))
    total = measured.agg(F.sum("n")).first()[0] or 0
    buckets = max(BUCKETS, total // BUCKET_BYTES)
    runs = repeated_runs(_written(_occurrences(keyed, firsts, int(buckets), rows), "contexts"))
    spans = runs.groupBy("node").agg(
        F.collect_list(F.struct("start", "n", "first_id", "first_start")).alias("runs")
    )
    known = _written(firsts.join(spans, "node", "left"), "removals")
    own = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), *keep
    )
    return _without(own, known, keep)


def _without(own: DataFrame, known: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    kind = own.schema["__id"].dataType
    span_type = T.StructType().add("start", "long").add("end", "long")
    out_schema = T.StructType().add("id", kind).add("kept", "binary").add("n_bytes", "long")
    out_schema = out_schema.add("spans", T.ArrayType(span_type)).add("kept_text", "string")
    for name in keep:
        out_schema = out_schema.add(own.schema[name])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text", PIECE_BYTES):
            node = text_hashes(*text_of(batch.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(node)], [*batch.schema.names, "__node"]
            )

    joined = own.mapInArrow(released(key), T.StructType([*own.schema, T.StructField("__node", T.LongType())])).join(
        known.select(F.col("node").alias("__node"), F.col("first").alias("__first"), F.col("runs").alias("__runs")),
        "__node", "left",
    ).select("__id", "__text", *keep, "__first", "__runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text", PIECE_BYTES):
            data, bounds = text_of(batch.column("__text"))
            raw = data.tobytes()
            out: list[list] = [[], [], [], []]
            ids, firsts, runs = (batch.column(c).to_pylist() for c in ("__id", "__first", "__runs"))
            for i, (key_, first, spans) in enumerate(zip(ids, firsts, runs, strict=True)):
                text = raw[bounds[i] : bounds[i + 1]]
                if (_LAST if key_ is None else key_) != first:
                    merged = [(0, len(text))] if len(text) >= LENGTH else []
                else:
                    merged = merge_spans(
                        (s["start"], s["start"] + s["n"] + LENGTH - 1) for s in spans or []
                        if (s["first_id"], s["first_start"]) != (first, s["start"])
                    )
                kept, last = [], 0
                for a, b in merged:
                    kept.append(text[last:a])
                    last = b
                kept.append(text[last:])
                left = b"".join(kept)
                ends = [{"start": a, "end": b} for a, b in merged]
                for column, value in zip(out, (left, len(text), ends, left.decode("utf-8", "ignore")), strict=True):
                    column.append(value)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.list_(span)), pa.array(out[3], pa.string()), *[batch.column(n) for n in keep],
                ],
                ["id", "kept", "n_bytes", "spans", "kept_text", *keep],
            )

    return joined.mapInArrow(released(cut), out_schema)


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
