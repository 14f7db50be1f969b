"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents. Its words that the test phrases know become
symbols, any other word and each document's end a separator. The shard's
Burrows-Wheeler transform is kept in a wavelet matrix, whose ranks drive the
backward search of all test phrases; sampled suffix positions locate their
occurrences, and overlapping ones are merged into removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentry.sources.workspace import stage

from .common import HashIndex, byte_class, check_carried, of_rows, pieces, released, text_of, word_places, words

WORD_BYTES = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
WINDOW = 13
BLOCK_BYTES = 16 << 20  # word hashes of test phrases held at once; more are searched block by block
SHARD_BYTES = 1 << 20  # text of a shard; a longer one is a shard of its own
SAMPLED = 8  # one suffix position in so many is kept


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; each round sorts only the suffixes that still tie."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.r_[True, np.diff(text[order]) != 0] if n else np.zeros(0, bool)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_places = np.flatnonzero(~(new & np.r_[new[1:], True])) if n else np.zeros(0, np.int64)
    step = 1
    while len(open_places):
        members = order[open_places]
        second = np.where(members + step < n, rank[np.minimum(members + step, n - 1)] + 1, 0)
        keys = rank[members] << 32 | second
        by = np.argsort(keys, kind="stable")
        members, keys = members[by], keys[by]
        order[open_places] = members
        new = np.r_[True, keys[1:] != keys[:-1]]
        rank[members] = open_places[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
        open_places = open_places[~(new & np.r_[new[1:], True])]
        step *= 2
    return order


class FMIndex:
    """Backward search and location over a text of symbols 1 .. symbols - 1; 0 is put at its end."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.r_[text, 0]
        order = suffix_array(text)
        bwt = text[order - 1]  # the first suffix is preceded by the end
        self.length = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        level = bwt
        for bit in reversed(range(self.bits)):
            is_one = (level >> bit & 1).astype(bool)
            count = np.zeros(len(level) + 1, np.int32)
            np.cumsum(is_one, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(level) - int(count[-1]))
            level = np.concatenate([level[~is_one], level[is_one]])
        self.start = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))
        self.sampled = order % SAMPLED == 0
        self.sample = order[self.sampled]
        self.sample_place = np.cumsum(self.sampled) - 1

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ones[place]
            place = np.where(symbol >> (self.bits - 1 - level) & 1, zeros + one, place - one)
        return place

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rows before ``place`` whose preceding symbol is ``symbol``, as a place among its suffixes."""
        return self.before[symbol] + self._descend(symbol, place) - self.start[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, the rows of a matrix, filled to the right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.length, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            going = np.flatnonzero((lengths >= back) & (low < high))
            if not len(going):
                break
            symbol = phrases[going, -back]
            low[going], high[going] = self.step(symbol, low[going]), self.step(symbol, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walking back to a sampled one."""
        out, walked = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        going, at = np.arange(len(rows)), rows.copy()
        while len(going):
            here = self.sampled[at]
            out[going[here]] = self.sample[self.sample_place[at[here]]] + walked[going[here]]
            going, at = going[~here], at[~here]
            symbol, place = np.zeros(len(at), np.int64), at
            for ones, zeros in zip(self.ones, self.zeros, strict=True):
                one = ones[place]
                is_one = ones[place + 1] > one
                symbol = symbol << 1 | is_one
                place = np.where(is_one, zeros + one, place - one)
            at = self.before[symbol] + place - self.start[symbol]
            walked[going] += 1
        return out


class Phrases:
    """One block of distinct test phrases, given as the hashes of their words, as symbols."""

    def __init__(self, phrases: list[bytes]):
        self.keys = phrases
        self.lengths = np.array([len(p) // 8 for p in phrases], np.int64)
        hashes = np.frombuffer(b"".join(phrases), np.uint64)
        known = np.unique(hashes)
        self.index, self.symbols = HashIndex(known), len(known) + 2
        width = int(self.lengths.max(initial=0))
        self.matrix = np.zeros((len(phrases), width), np.int64)
        row = np.repeat(np.arange(len(phrases)), self.lengths)
        place = np.arange(len(hashes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.matrix[row, place + width - self.lengths[row]] = np.searchsorted(known, hashes) + 2

    def occurrences(self, hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence within a row's words."""
        nothing = np.zeros(0, np.int64)
        if not len(self.lengths) or not len(hashes):
            return nothing, nothing
        symbol = self.index.find(hashes).astype(np.int64) + 2  # 1: not known, and the separator
        known = symbol > 1
        first = np.zeros(len(hashes) + 1, bool)
        first[of] = True
        start = np.flatnonzero(known & (first[:-1] | ~np.r_[False, known[:-1]]))
        end = np.flatnonzero(known & (first[1:] | ~np.r_[known[1:], False])) + 1
        long = end - start >= self.lengths.min()  # a shorter run of known words holds no phrase
        start, end = start[long], end[long]
        if not len(start):
            return nothing, nothing
        size = end - start + 1  # and its separator
        at = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(at, size) + np.repeat(start, size)
        text = np.where(place < np.repeat(end, size), symbol[np.minimum(place, len(symbol) - 1)], 1)
        index = FMIndex(text, self.symbols)
        low, high = index.search(self.matrix, self.lengths)
        count = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[phrase]
        return phrase, place[index.locate(rows)]


def item_phrases(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item, phrase): every phrase of the benchmark's rows, as the hashes of its words, with the items that hold it."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, of = words(*text_of(batch.column("text")), WORD_BYTES)
            count = np.diff(of)
            size = np.minimum(count, window)
            number = np.where(count > 0, count - size + 1, 0)
            row = np.repeat(np.arange(len(count)), number)
            start = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + of[:-1][row]
            raw = hashes.tobytes()
            found = [raw[8 * a : 8 * b] for a, b in zip(start.tolist(), (start + size[row]).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(row)), pa.array(found, pa.binary())], ["item", "phrase"]
            )

    return rows.mapInArrow(released(run), f"item {kind}, phrase binary").distinct()


def _merged(opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
    """Spans joined where they overlap or touch: n x 2, in order."""
    by = np.argsort(opens, kind="stable")
    opens, reach = opens[by], np.maximum.accumulate(closes[by])
    first = np.flatnonzero(np.r_[True, opens[1:] > reach[:-1]]) if len(by) else by
    return np.stack([opens[first], reach[np.r_[first[1:], len(by)] - 1]], 1) if len(by) else np.zeros((0, 2), np.int64)


_SPANS = "array<struct<first:int,last:int,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _scanned(keyed: DataFrame, block: Broadcast) -> DataFrame:
    """(a, b, spans, phrases) of texts that hold phrases of the block: spans of words and bytes, and the phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        for batch in pieces(batches, "__text", SHARD_BYTES):
            data, bounds = text_of(batch.column("__text"))
            hashes, start, end, of = word_places(data, bounds, WORD_BYTES)
            phrase, first = phrases.occurrences(hashes, of)
            spans = _merged(first, first + phrases.lengths[phrase])
            row = of_rows(of)
            # phrases that follow each other over a document's end are two spans
            cut = np.searchsorted(of, spans[:, 0], "right")
            spans = [
                (a, b) for (low, high), to in zip(spans.tolist(), of[cut].tolist(), strict=True)
                for a, b in _parts(low, high, to, of)
            ]
            pair = np.unique(row[first] * len(phrases.keys) + phrase) if len(first) else first
            held: dict[int, tuple[list, list]] = {}
            for a, b in spans:
                base, own = int(bounds[row[a]]), int(of[row[a]])
                line = (a - own, b - own, int(start[a]) - base, int(end[b - 1]) - base)
                held.setdefault(int(row[a]), ([], []))[0].append(dict(zip(("first", "last", "start", "end"), line, strict=True)))
            for key in pair.tolist():
                held[key // len(phrases.keys)][1].append(phrases.keys[key % len(phrases.keys)])
            docs = pa.array(list(held), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__a").take(docs), batch.column("__b").take(docs),
                    pa.array([h[0] for h in held.values()], _SPAN), pa.array([h[1] for h in held.values()], pa.list_(pa.binary())),
                ],
                ["a", "b", "spans", "phrases"],
            )

    return keyed.mapInArrow(released(run), f"a bigint, b bigint, spans {_SPANS}, phrases array<binary>")


def _parts(low: int, high: int, end: int, of: np.ndarray) -> Iterator[tuple[int, int]]:
    """A span of words cut at the ends of documents; ``end`` is that of the first one."""
    while high > end:
        if end > low:
            yield low, end
        low, end = end, int(of[np.searchsorted(of, end, "right")])
    yield low, high


def _hits(keyed: DataFrame, phrases: DataFrame) -> DataFrame:
    """What all blocks find, one after the other: of the phrases no more than a block is ever held at once."""
    spark = keyed.sparkSession
    distinct = stage(phrases.select("phrase").distinct(), "phrases")
    size = distinct.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    count = int(size // BLOCK_BYTES) + 1
    found = []
    for number in range(count):
        block = distinct.where(F.pmod(F.xxhash64("phrase"), F.lit(count)) == number).orderBy("phrase").collect()
        held = spark.sparkContext.broadcast(Phrases([bytes(r["phrase"]) for r in block]))
        found.append(stage(_scanned(keyed, held), "phrase-hits"))
        held.destroy()
    return reduce(DataFrame.union, found)


def _united(hits: DataFrame) -> DataFrame:
    """(a, b, n_hit, spans) of each text, from the spans that blocks and copies of it gave."""
    lists = hits.groupBy("a", "b").agg(F.flatten(F.collect_set("spans")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], []]
            for spans in batch.column("spans").to_pylist():
                first, last, start, end = (np.array([s[c] for s in spans], np.int64) for c in ("first", "last", "start", "end"))
                merged = _merged(first, last)
                of = np.searchsorted(merged[:, 0], first, "right") - 1
                low, high = np.full(len(merged), np.iinfo(np.int64).max), np.zeros(len(merged), np.int64)
                np.minimum.at(low, of, start)
                np.maximum.at(high, of, end)
                out[0].append(int((merged[:, 1] - merged[:, 0]).sum()))
                out[1].append([{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist(), strict=True)])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(out[0], pa.int64()), pa.array(out[1], span)],
                ["a", "b", "n_hit", "spans"],
            )

    return lists.mapInArrow(run, "a bigint, b bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>")


def _counted(keyed: DataFrame) -> DataFrame:
    """The rows with their number of words in place of their text."""
    schema = T.StructType([f for f in keyed.schema if f.name != "__text"]).add("n_words", "long")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text", SHARD_BYTES):
            _, of = words(*text_of(batch.column("__text")), WORD_BYTES)
            columns = [batch.column(n) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(of), pa.int64())], names)

    return keyed.mapInArrow(released(run), schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row (id, n_words, n_hit, spans, items) per document, repeated rows included.

    A test phrase is ``window`` consecutive words of an item, or the whole of a
    shorter one; items without words have none. n_hit counts the words inside
    any occurrence, ``spans`` are the merged occurrences as (start, end) bytes
    of the text, ``items`` the distinct item ids that occur, in order, a null id
    last. Null and empty texts have no words, and without documents or test
    phrases there are no rows or no hits; a text of any length is one shard at least. ``keep`` names columns to carry,
    a ValueError where they clash with these.

    Distinct phrases are found by Spark and searched in blocks of ``BLOCK_BYTES``, a scan of
    the documents each; what the blocks find is staged and united per
    distinct text (told by 128 bits of hashes).
    """
    check_carried(keep, ("id", "n_words", "n_hit", "spans", "items", "__a", "__b", "__text"))
    phrases = stage(item_phrases(benchmark, window, item_col, item_text_col), "item-phrases")
    text = F.col(text_col).cast("string")
    same = [F.xxhash64(text).alias("__a"), F.xxhash64(F.lit(1), text).alias("__b")]
    hits = _hits(docs.select(*same, text.alias("__text")), phrases)
    items = (
        hits.select("a", "b", F.explode("phrases").alias("phrase")).distinct().join(phrases, "phrase")
        .groupBy("a", "b").agg(F.array_sort(F.collect_set(F.struct(F.col("item").isNull().alias("last"), "item"))).alias("items"))
        .select("a", "b", F.transform("items", lambda i: i["item"]).alias("items"))
    )
    known = stage(_united(hits).join(items, ["a", "b"]), "contaminated")
    rows = _counted(docs.select(F.col(id_col).alias("id"), *keep, *same, text.alias("__text")))
    found = known.withColumnsRenamed({"a": "__a", "b": "__b"})
    return rows.join(found, ["__a", "__b"], "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast(known.schema["items"].dataType)).alias("items"), *keep,
    )


def is_contaminated(n_hit="n_hit", n_words="n_words"):
    """A twentieth of the words or more are hit."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))
