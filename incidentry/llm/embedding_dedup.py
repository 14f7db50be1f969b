"""Near-duplicate embeddings by cross-polytope hashing.

Vectors are rotated at random by sign flips and fast Hadamard transforms; the
largest coordinate and its sign are a hash, several of them a bucket. A vector
is put into its bucket of each table and probes the buckets that one
second-largest coordinate would give. The cosine of each pair that meets is
computed once, in the first table where it meets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from incidentry.sources.workspace import stage

from .graph import connected_components
from .vectors import list_column, matrices, packed_column

TABLES = 14
HASHES = 3  # rotations that make up a bucket; add one for each hundredfold of vectors beyond some millions
BLOCK = 256  # vectors of a bucket compared with as many others at once
COSINE = 0.95


def hadamard(columns: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each column; their length is a power of two."""
    width, n = columns.shape
    step = 1
    while step < width:  # butterflies of whole rows, which lie together in memory
        pair = columns.reshape(-1, 2, step, n)
        columns = np.empty_like(pair)
        np.add(pair[:, 0], pair[:, 1], out=columns[:, 0])
        np.subtract(pair[:, 0], pair[:, 1], out=columns[:, 1])
        step *= 2
    return columns.reshape(width, n)


def bucket_codes(vectors: np.ndarray, tables: int, hashes: int, seed: int = 3) -> np.ndarray:
    """Bucket (column 0) and probed buckets of each vector in each table: n x tables x (hashes + 1)."""
    width = 1 << max(int(vectors.shape[1] - 1).bit_length(), 1)
    padded = np.zeros((width, len(vectors)))
    padded[: vectors.shape[1]] = vectors.T
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, hashes, 3, width))
    out = np.zeros((len(vectors), tables, hashes + 1), np.int64)
    each = np.arange(len(vectors))
    for t in range(tables):
        first, second = [], []
        for h in range(hashes):
            turned = padded
            for k in range(3):
                turned = hadamard(turned * signs[t, h, k][:, None])
            turned = turned.T.copy()
            size = np.abs(turned)
            top = size.argmax(1)
            size[each, top] = -1
            next_top = size.argmax(1)
            first.append(2 * top + (turned[each, top] < 0))
            second.append(2 * next_top + (turned[each, next_top] < 0))
        for probe in range(hashes + 1):
            code = np.zeros(len(vectors), np.int64)
            for h in range(hashes):
                code = code * (2 * width) + (second[h] if h == probe - 1 else first[h])
            out[:, t, probe] = code
    return out


def units(matrix: np.ndarray) -> np.ndarray:
    """The rows, none of them zero, at length 1 in double precision."""
    matrix = matrix / np.abs(matrix).max(1)[:, None]
    return matrix / np.sqrt((matrix * matrix).sum(1))[:, None]


def _sound(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(row numbers, matrix, nodes) of the vectors that have a direction, each length apart.

    A node is a digest of the vector; -0.0 counts as 0.0, as it does where Spark groups.
    """
    for at, matrix in matrices(batch.column("embedding")):
        some = np.flatnonzero(matrix.any(1))
        matrix = matrix[some] + 0.0
        if len(some):
            yield at[some], matrix, [hashlib.blake2b(row, digest_size=16).digest() for row in matrix]


_HASHED = "node binary, ids {kind}, copies bigint, vector binary, codes array<bigint>"


def hash_vectors(classes: DataFrame, kind: str, tables: int, hashes: int, number: type = np.float64) -> DataFrame:
    """Distinct vectors, kept as ``number``s, with a digest of their own as node, and their buckets in all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix, nodes in _sound(batch):
                codes = bucket_codes(units(matrix), tables, hashes, seed=3 + matrix.shape[1]).reshape(len(at), -1)
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes, pa.binary()), rows.column("id"), rows.column("copies"),
                        packed_column(matrix, number), list_column(codes, pa.int64()),
                    ],
                    ["node", "ids", "copies", "vector", "codes"],
                )

    return classes.mapInArrow(run, _HASHED.format(kind=kind))


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bucket in which the vectors of each pair meet in a table, -1 for none; codes n x probes of both."""
    a_home, b_home = (b == a[:, :1]).any(1), (a == b[:, :1]).any(1)  # one is put into, or probes, the other's bucket
    both = np.minimum(a[:, 0], b[:, 0])
    return np.where(a_home & b_home, both, np.where(a_home, a[:, 0], np.where(b_home, b[:, 0], -1)))


def _least_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least of the numbers below n that each one reaches by the links, which are given both ways."""
    least = np.arange(n)
    while True:
        before = least.copy()
        np.minimum.at(least, least[a], least[b])
        while (least[least] != least).any():
            least = least[least]
        if (least == before).all():
            return least


def compare_blocks(
    nodes: np.ndarray, vectors: np.ndarray, codes: np.ndarray, side: np.ndarray, table: int, bucket: int,
    copies: np.ndarray, cosine: float,
) -> list[tuple[bytes, bytes, int]]:
    """(node, least node that the links found here reach from it, links) of members of one block pair.

    ``side`` is 0 or 1 for the two blocks; all 0 compares a block with itself.
    The least node of the neighbours alone would lose links: of a chain x - a - b - y,
    a would go on with x and b with y, and the link of a and b with neither.
    """
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    same = not len(right)
    if same:
        right = left
    i, j = np.nonzero(vectors[left] @ vectors[right].T >= cosine)
    i, j = left[i], right[j]
    kept = nodes[i] != nodes[j]
    if same:
        kept &= i < j
    i, j = i[kept], j[kept]
    for t in range(table):  # the first table where a pair meets has it
        kept = _meet(codes[i, t], codes[j, t]) < 0
        i, j = i[kept], j[kept]
    kept = _meet(codes[i, table], codes[j, table]) == bucket
    i, j = i[kept], j[kept]
    i, j = np.r_[i, j], np.r_[j, i]
    if not len(i):
        return []
    by_node = sorted(range(len(nodes)), key=nodes.__getitem__)
    rank = np.empty(len(nodes), np.int64)
    rank[by_node] = np.arange(len(nodes))
    least = _least_reached(rank[i], rank[j], len(nodes))
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, i, copies[j])
    return [(nodes[m], nodes[by_node[least[rank[m]]]], int(links[m])) for m in np.unique(i).tolist()]


def near_duplicate_embeddings(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row (id, n_links, component_id, kept) per vector, repeated rows included.

    Equal vectors are one class, linked with each other. Vectors that are null,
    empty, zero, or hold null or non-finite components, and vectors of another
    length, link with nothing. A pair below ``cosine`` is never linked; a pair
    at the limit is found with a probability of about 1 - 0.5**tables.
    component_id is the least id that links reach, nulls aside. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("embedding")
    )
    kind = rows.schema["id"].dataType.simpleString()
    single = isinstance(vectors.select(F.col(vector_col)).schema[0].dataType.elementType, FloatType)
    number = np.float32 if single else np.float64  # in which vectors travel; sums are in double precision
    classes = rows.groupBy("embedding").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    hashed = stage(hash_vectors(classes, kind, tables, hashes, number), "hashed-vectors")
    width = hashes + 1
    postings = hashed.select("node", F.posexplode("codes").alias("place", "bucket")).select(
        "node", F.floor(F.col("place") / width).cast("int").alias("table"), "bucket",
        (F.col("place") % width == 0).alias("home"),
    )
    blocks = (
        postings.groupBy("table", "bucket")
        .agg(F.count(F.lit(1)).alias("members"), F.max("home").alias("home"))
        .where("home AND members > 1")
        .select("table", "bucket", F.ceil(F.col("members") / F.lit(BLOCK)).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int")
    dealt = (
        postings.join(blocks, ["table", "bucket"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", "table", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
        )
        .join(hashed.select("node", "copies", "vector", "codes"), "node")
        .repartition("table", "bucket", "i", "j")
        .sortWithinPartitions("table", "bucket", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            if rest is not None:
                some = pa.concat_tables([rest, some])
            keys = np.stack([some.column(c).to_numpy() for c in ("table", "bucket", "i", "j")])
            last = int(np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])[-1])
            rest = some.slice(last)  # may go on in the next batch
            if last:
                yield from _compared(some.slice(0, last), tables, width, cosine, number)
        if rest is not None and rest.num_rows:
            yield from _compared(rest, tables, width, cosine, number)

    found = stage(dealt.mapInArrow(run, "node binary, least binary, links bigint"), "vector-links")
    roots = connected_components(found, "node", "least")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        hashed.select("node", "ids", "vector").join(roots, "node", "left").join(links, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = stage(named.groupBy("root").agg(F.min("ids").alias("component_id")), "least-ids")
    of_class = stage(
        named.join(least, "root").select("node", F.coalesce("links", F.lit(0)).alias("links"), "component_id"),
        "vector-classes",
    )
    # a row finds its class by the digest of its vector
    keyed = rows.mapInArrow(_digests, f"id {kind}, node binary")
    own = hashed.select("node", "copies").join(of_class, "node")
    return keyed.join(own, "node", "left").select(
        "id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.full(batch.num_rows, None, object)
        for at, _, nodes in _sound(batch):
            out[at] = nodes
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out.tolist(), pa.binary())], ["id", "node"])


def _compared(some: pa.Table, tables: int, width: int, cosine: float, number: type) -> Iterator[pa.RecordBatch]:
    keys = np.stack([some.column(c).to_numpy() for c in ("table", "bucket", "i", "j")])
    cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0), True])
    nodes = np.array(some.column("node").to_pylist() + [None], object)[:-1]
    raw = some.column("vector").to_pylist()
    codes = some.column("codes").combine_chunks().flatten().to_numpy().reshape(-1, tables, width)
    side, copies = some.column("side").to_numpy(), some.column("copies").to_numpy()
    out = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        by_length: dict[int, list[int]] = {}
        for i in range(low, high):
            by_length.setdefault(len(raw[i]), []).append(i)
        table, bucket, i, j = keys[:, low].tolist()
        for members in by_length.values():
            pick = np.array(members)
            if len(pick) < 2 or (i != j and len(set(side[pick].tolist())) < 2):
                continue
            vectors = np.frombuffer(b"".join([raw[k] for k in members]), number).reshape(len(pick), -1)
            out += compare_blocks(
                nodes[pick], units(vectors.astype(np.float64)), codes[pick], side[pick], table, bucket, copies[pick], cosine
            )
    if out:
        node, least, links = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.binary()), pa.array(least, pa.binary()), pa.array(links, pa.int64())],
            ["node", "least", "links"],
        )
