"""Similarity join of documents on the Jaccard similarity of their word shingles.

Shingles are ordered rarest first. Two documents that reach the limit share one
of the first |x| - ceil(limit * |x|) + 1 shingles of either (the prefix), so
candidates come from an equi-join on prefix shingles, under length and
positional filters. A pair passes a suffix filter and is verified once. Since a
shingle of one document only joins nothing, only shared shingles are kept, and
only those of documents whose prefix holds one.

Documents with the same words are one node. Within a group that is connected
already no further pair is made: a first round links every document with the
most central one of its posting lists, and a second joins across the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentry.sources.workspace import stage

from .common import byte_class, mixed, of_rows, pieces, powers, released, text_of, words
from .graph import connected_components

WORDS = 5
PERCENT = 80
BUCKET_SHINGLES = 2_000_000  # shingles counted together in one task
LEAST_BUCKETS = 64
GATHERED = 1 << 19  # shingles of a task that are packed together
PIECE_BYTES = 1 << 19  # text whose shingles are made at once
HELD = 6_000_000  # shingles of a bucket held before common ones are sent on
COMMON = 1 << 18  # texts up to which a shingle is counted; commoner ones are ordered by their hash
BANDS = 20  # bands of set sizes within a factor of e
WORD_BYTES = ~byte_class((0x20, 0x20), (0x09, 0x0D))

_FACTORS = np.random.default_rng(17).integers(1, 1 << 63, (2, 2 * WORDS), dtype=np.uint64) | np.uint64(1)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, their bounds, and two hashes of each row's words.

    A row of fewer than ``WORDS`` words, but not none, has the whole sequence as one shingle.
    """
    word, of = words(data, bounds, WORD_BYTES)
    count = np.diff(of)
    sums = np.zeros(len(word), np.uint64)
    for k in range(WORDS):
        sums[: max(len(word) - k, 0)] += word[k:] * _FACTORS[0, k]
    row = of_rows(of)
    place = np.arange(len(word)) - of[:-1][row]
    keep = place + WORDS <= count[row]
    values = sums[keep]
    size = np.maximum(count - WORDS + 1, 0)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        lines = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            has = count[short] > k
            lines[has] += word[of[:-1][short[has]] + k] * _FACTORS[0, k]
        lines += _FACTORS[1, count[short]]
        values = np.insert(values, np.repeat(np.cumsum(size)[short], 1), lines)
        size[short] = 1
    values = mixed(values)
    ends = np.cumsum(size)
    starts = ends - size
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        values[a:b].sort()
    new = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
    new[starts[size > 0]] = True
    sums = np.concatenate([[0], np.cumsum(new)])
    return values[new], np.r_[0, sums[ends]], sequence_hashes(word, of)


def sequence_hashes(word: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each row's sequence of word hashes."""
    out = []
    for base in _BASES:
        sums = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(word * powers(len(word), base), out=sums[1:])
        back = powers(len(word) + 1, pow(base, -1, 1 << 64))
        line = (sums[of[1:]] - sums[of[:-1]]) * back[of[:-1]]
        out.append(mixed(line + np.diff(of).astype(np.uint64) * np.uint64(_BASES[0])))
    return np.stack(out, 1)


def _measured(rows: DataFrame, kind: str) -> DataFrame:
    """(id, node, n) of each row: a hash of its words, null without any, and the size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            _, bounds, keys = shingle_sets(*text_of(batch.column("text")))
            n = np.diff(bounds)
            node = pa.array(keys[:, 0].view(np.int64), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), node, pa.array(n)], ["id", "node", "n"])

    return rows.mapInArrow(released(run), f"id {kind}, node bigint, n bigint")


def _dealt_shingles(rows: DataFrame, buckets: int) -> DataFrame:
    """Every task's shingles, packed by bucket, each distinct text once.

    Shingles are gathered over texts, up to ``GATHERED``, so that a row holds many whatever the number of buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple] = []
        for batch in pieces(batches, "text", PIECE_BYTES):
            values, bounds, keys = shingle_sets(*text_of(batch.column("text")))
            n, nodes = np.diff(bounds), keys[:, 0].view(np.int64)
            fresh = np.zeros(len(n), bool)
            for i, node in enumerate(nodes.tolist()):
                fresh[i] = n[i] > 0 and node not in seen
                seen.add(node)
            row = of_rows(bounds)
            held.append((values[fresh[row]], np.where(fresh, n, 0), nodes))
            if sum(len(h[0]) for h in held) >= GATHERED:
                yield _packed_shingles(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)
                held = []
        if held:
            yield _packed_shingles(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)

    return rows.mapInArrow(released(run), "bucket int, high binary, low binary, nodes binary, ns binary, counts binary")


def _packed_shingles(values: np.ndarray, n: np.ndarray, nodes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket, a range of the leading 32 bits of the hash; the last 48 bits are kept."""
    row = np.repeat(np.arange(len(n)), n)
    bucket = (((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    values, row, bucket = values[by], row[by], bucket[by]
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(by) else np.zeros(1, int)
    out: list[list] = [[] for _ in _PACKED]
    for a, b in zip(cut, cut[1:], strict=False):
        of = np.flatnonzero(np.r_[True, row[a + 1 : b] != row[a : b - 1], True])
        members, part = row[a + of[:-1]], values[a:b]
        packed = (
            (part >> np.uint64(16)).astype(np.uint32), part.astype(np.uint16), nodes[members],
            n[members].astype(np.int32), np.diff(of).astype(np.int32),
        )
        for column, value in zip(out, (int(bucket[a]), *(x.tobytes() for x in packed)), strict=True):
            column.append(value)
    kinds = (pa.int32(), *[pa.binary()] * 5)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _PACKED)


_PACKED = ["bucket", "high", "low", "nodes", "ns", "counts"]


def _shared_shingles(packed: DataFrame, buckets: int) -> DataFrame:
    """(node, n, h, df) of every shingle that is in more than one distinct text; df is ``COMMON`` at most.

    A text that several tasks hold may come with a shingle more than once, and may make its own ones look shared: all
    that is needed of df is that it is one number for each shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        for batch in batches:
            for row in batch.to_pylist():
                if bucket is None or row["bucket"] != bucket.number:
                    if bucket is not None:
                        yield from bucket.rest()
                    bucket = _Bucket(row["bucket"])
                yield from bucket.add(row)
        if bucket is not None:
            yield from bucket.rest()

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(released(run), "node bigint, n int, h bigint, df int")


class _Bucket:
    """Shingles of a bucket with their texts, held until the last one is known or they are found to be common."""

    def __init__(self, number: int):
        self.number, self.size, self.limit, self.parts = number, 0, HELD, []
        self.common = np.zeros(0, np.uint64)  # sorted

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        values = np.frombuffer(row["high"], np.uint32).astype(np.uint64) << np.uint64(16)
        values |= np.frombuffer(row["low"], np.uint16)
        self.parts.append((values, *(np.frombuffer(row[c], k) for c, k in (("nodes", np.int64), ("ns", np.int32), ("counts", np.int32)))))
        self.size += len(values)
        if self.size > self.limit:
            yield from self._sent()

    def _expanded(self, keep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values, nodes and set sizes of the postings that ``keep`` picks, given all values."""
        values = np.concatenate([p[0] for p in self.parts])
        pick = keep(values)
        counts = np.concatenate([p[3] for p in self.parts])
        nodes, n = (np.repeat(np.concatenate([p[i] for p in self.parts]), counts)[pick] for i in (1, 2))
        return values[pick], nodes, n

    def _sent(self) -> Iterator[pa.RecordBatch]:
        """Send on what is common already; later postings of the same shingles follow when next too many are held."""
        values, times = np.unique(np.concatenate([p[0] for p in self.parts]), return_counts=True)
        self.common = np.union1d(self.common, values[times >= COMMON])
        values, nodes, n = self._expanded(lambda v: np.isin(v, self.common))
        yield from _postings(self.number, values, nodes, n, np.full(len(values), COMMON))
        values, nodes, n = self._expanded(lambda v: np.isin(v, self.common, invert=True))
        self.parts = [(values, nodes, n, np.ones(len(values), np.int32))]
        self.size, self.limit = len(values), max(HELD, len(values) * 3 // 2)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if len(self.common):
            yield from self._sent()

        def repeated(values: np.ndarray) -> np.ndarray:
            by = np.argsort(values)
            same = np.r_[False, values[by][1:] == values[by][:-1], False]  # as the one before
            return by[same[:-1] | same[1:]] if len(by) else by

        values, nodes, n = self._expanded(repeated)
        by = np.lexsort((nodes, values))
        values, nodes, n = values[by], nodes[by], n[by]
        new = np.r_[True, (values[1:] != values[:-1]) | (nodes[1:] != nodes[:-1])] if len(by) else np.zeros(0, bool)
        values, nodes, n = values[new], nodes[new], n[new]
        start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
        size = np.diff(np.r_[start, len(values)])
        df = np.repeat(size, size)
        keep = df > 1
        yield from _postings(self.number, values[keep], nodes[keep], n[keep], np.minimum(df[keep], COMMON))


def _postings(bucket: int, values, nodes, n, df) -> Iterator[pa.RecordBatch]:
    h = (values << np.uint64(16) | np.uint64(bucket & 0xFFFF)).view(np.int64)
    columns, step = (nodes, n, h, df.astype(np.int32)), 100_000
    for a in range(0, len(h), step):
        yield pa.RecordBatch.from_arrays([pa.array(c[a : a + step]) for c in columns], ["node", "n", "h", "df"])


def _candidate_sets(shared: DataFrame) -> DataFrame:
    """(node, n, prefix, shingles, dfs) of documents whose prefix holds a shared shingle.

    ``shingles`` are the shared ones, rarest first; ``prefix`` of them belong to
    the prefix, the shingles of this text alone having gone first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            if rest is not None:
                some = pa.concat_tables([rest, some]).combine_chunks()
            node = some.column("node").to_numpy()
            cut = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            rest = some.slice(int(cut[-1]))
            if len(cut) > 1:
                yield from _prefixed(some, cut)
        if rest is not None and rest.num_rows:
            yield from _prefixed(rest.combine_chunks(), np.array([0, rest.num_rows]))

    dealt = shared.repartition("node").sortWithinPartitions("node", "df", "h")
    return dealt.mapInArrow(
        released(run), "node bigint, n int, prefix int, shingles array<bigint>, dfs array<int>"
    )


def _prefixed(some: pa.Table, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of whole documents, from cut[0] up to cut[-1]; a shingle that came twice counts once."""
    node, n, h, df = (some.column(c).to_numpy()[: cut[-1]] for c in ("node", "n", "h", "df"))
    new = np.r_[True, (node[1:] != node[:-1]) | (h[1:] != h[:-1])]
    if not new.all():
        node, n, h, df = node[new], n[new], h[new], df[new]
        cut = np.r_[0, np.cumsum(new)][cut]
    size, n = np.diff(cut), n[cut[:-1]].astype(np.int64)
    prefix = n - -(-n * PERCENT // 100) + 1 - (n - size)
    keep = prefix > 0
    inside = np.repeat(keep, size)
    bounds = pa.array(np.r_[0, np.cumsum(size[keep])], pa.int32())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(node[cut[:-1]][keep]), pa.array(n[keep].astype(np.int32)), pa.array(prefix[keep].astype(np.int32)),
            pa.ListArray.from_arrays(bounds, pa.array(h[: cut[-1]][inside])),
            pa.ListArray.from_arrays(bounds, pa.array(df[: cut[-1]][inside])),
        ],
        ["node", "n", "prefix", "shingles", "dfs"],
    )


def _least_overlap(n: Column, m: Column) -> Column:
    """Shingles that sets of n and m must share at least."""
    return F.ceil((n + m) * PERCENT / (100 + PERCENT))


def _filters(a: str, b: str) -> Column:
    """Length filter, and positional filter: enough shingles stand behind the first one in common."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    behind = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place"))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT) & (behind >= _least_overlap(n, m))


def _by_bands(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries of posting lists as the larger and as the smaller one of a pair, by bands of the smaller one's size.

    With r shingles from its place on, a set of n can only meet, among sets no larger, sizes of 0.8 n to 2.25 r - n;
    and it can only meet one no smaller if r is 8/9 n at least. So the length and the positional filter hold, up
    to the width of a band, before entries meet: documents that share much, but too little, are never paired. Entries of the
    main group of a list meet those of other groups only (``side``).
    """
    rest, n = F.col("n") - F.col("place"), F.col("n").cast("double")

    def band(size: Column) -> Column:
        return F.floor(F.log(size) * F.lit(float(BANDS))).cast("int")

    most = F.least(n, F.floor(rest * F.lit(100 + PERCENT) / F.lit(PERCENT)) - n)
    low, high = band(F.ceil(n * F.lit(PERCENT) / F.lit(100))), band(F.greatest(most, F.lit(1.0)))
    entries = lists.select("h", "node", "n", "place", "root", (F.col("root") == F.col("main")).alias("inner"))
    asking = entries.where(most >= n * F.lit(PERCENT) / F.lit(100)).select(
        "*", F.explode(F.sequence(low, high)).alias("band"), F.col("inner").cast("int").alias("side")
    )
    sides = F.when(F.col("inner"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    answering = entries.where(rest * F.lit(100 + PERCENT) >= F.lit(2 * PERCENT) * n).select(
        "*", band(n).alias("band"), F.explode(sides).alias("side")
    )
    return asking, answering


def _within(x: np.ndarray, dfs: np.ndarray, h: int, df: int) -> int:
    """Place of a shingle in the rarest-first order of a set."""
    low, high = np.searchsorted(dfs, df, "left"), np.searchsorted(dfs, df, "right")
    return int(low + np.searchsorted(x[low:high], h))


def overlaps(x: np.ndarray, xd: np.ndarray, y: np.ndarray, yd: np.ndarray, least: int) -> bool:
    """Whether two sets of shared shingles, rarest first, have ``least`` in common.

    The suffix filter cuts both at the middle shingle of one: what the parts
    differ in size cannot be in common. What passes is counted exactly.
    """
    if min(len(x), len(y)) < least:
        return False
    middle = len(y) // 2
    at = _within(x, xd, int(y[middle]), int(yd[middle]))
    if min(at, middle) + min(len(x) - at, len(y) - middle) < least:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= least


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["xs", "xd", "ys", "yd"]
        for batch in batches:
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            least = -(-(n + m) * PERCENT // (100 + PERCENT))
            lists = [(batch.column(c).values.to_numpy(), batch.column(c).offsets.to_numpy()) for c in names]
            good = np.array([
                overlaps(*[values[of[i] : of[i + 1]] for values, of in lists], int(least[i]))
                for i in range(batch.num_rows)
            ], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good)) for c in ("a", "b")], ["a", "b"]
            )

    left = sets.select(F.col("node").alias("a"), "n", F.col("shingles").alias("xs"), F.col("dfs").alias("xd"))
    right = sets.select(
        F.col("node").alias("b"), F.col("n").alias("m"), F.col("shingles").alias("ys"), F.col("dfs").alias("yd")
    )
    return pairs.join(left, "a").join(right, "b").mapInArrow(released(run), "a bigint, b bigint")


def similar_pairs(sets: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect whatever all pairs at the limit would connect."""
    postings = stage(
        sets.select(
            "node", "n", (F.col("n") - F.size("shingles")).alias("own"),
            F.posexplode(F.slice("shingles", F.lit(1), F.col("prefix"))).alias("at", "h"),
        ).select("node", "n", "own", "h", (F.col("own") + F.col("at")).alias("place")),
        "postings",
    )
    central = F.struct((F.col("own") / F.col("n")).alias("rate"), "node", "n", "place")
    hubs = postings.groupBy("h").agg(F.min(central).alias("hub")).select("h", "hub.node", "hub.n", "hub.place")
    met = (
        postings.alias("a").join(hubs.alias("b"), F.col("a.h") == F.col("b.h"))
        .where((F.col("a.node") != F.col("b.node")) & _filters("a", "b"))
        .select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    )
    one_each = (
        met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("often"))
        .groupBy("a").agg(F.max(F.struct("often", "b")).alias("best")).select("a", "best.b")
    )
    tried = stage(one_each, "hub-pairs")
    links = stage(_verified(tried, sets), "hub-links")
    roots = connected_components(links)
    marked = stage(
        postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "marked-postings"
    )
    most = (
        marked.groupBy("h", "root").agg(F.count(F.lit(1)).alias("members"))
        .groupBy("h").agg(F.max(F.struct("members", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1").select(F.col("h").alias("key"), F.col("most.root").alias("main"))
    )
    open_lists = stage(marked.join(most, F.col("h") == F.col("key")).drop("key"), "open-postings")
    asking, answering = _by_bands(open_lists)
    across = (
        asking.alias("a").join(answering.alias("b"), ["h", "band", "side"])
        .where(
            (F.col("a.root") != F.col("b.root")) & _filters("a", "b")
            & (F.struct("a.n", "a.node") > F.struct("b.n", "b.node"))
        )
        .select(F.greatest("a.node", "b.node").alias("a"), F.least("a.node", "b.node").alias("b"))
        .distinct()
    )
    both = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    more = _verified(across.join(both, ["a", "b"], "left_anti"), sets)
    return stage(links.union(more.select("a", "b")), "links")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, n_shingles, component_id) per document, repeated rows included.

    Words are runs of anything but space and tab to carriage return, A-Z
    lower-cased. component_id is the least id of the documents that links reach,
    nulls aside. Null texts and texts without words have no shingles and their
    own id as component. Shingles and word sequences are compared by 64-bit
    hashes.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    measured = stage(_measured(rows, rows.schema["id"].dataType.simpleString()), "shingle-counts")
    total = measured.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_SHINGLES))
    shared = _shared_shingles(_dealt_shingles(rows, int(buckets)), int(buckets))
    sets = stage(_candidate_sets(shared), "candidate-sets")
    roots = connected_components(similar_pairs(sets))
    named = measured.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # staged, so that both sides of the join are shuffled for it alone and a hot root can be split
    least = stage(
        named.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id")), "least-ids"
    )
    return named.join(least, "root", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
