"""Byte-level BPE encoding and decoding with a public vocabulary file.

A word's parts are one contiguous array beside the array of ranks of adjacent
parts. The smallest rank is found by scanning, the boundary there is deleted,
and the ranks on both sides are refreshed; the new words of a batch go through
these steps together, as rows of a matrix. Words beyond
``SCAN_BYTES`` take their minima from a heap instead, with the same result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, pieces, released

SCAN_BYTES = 64
CACHED_WORDS = 200_000
PIECE_BYTES = 1 << 19  # text encoded at once
_NO_MERGE = (1 << 31) - 1
_TOGETHER = 20_000  # words merged in step

# The pattern by which byte-level BPE splits text into words, and the same for ASCII.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ASCII = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+"
    r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Merge ranks and token bytes of a byte-level BPE file in the JSON form.

    Raises ValueError for a file with a normaliser, another pre-tokeniser, or
    added tokens that strip or normalise their surroundings.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        added = spec["added_tokens"]
        if (
            spec["normalizer"] or model["type"] != "BPE" or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)
            or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        to_byte = printable_bytes()
        raw = lambda token: bytes(to_byte[c] for c in token)
        special = {t["content"]: t["id"] for t in added}
        self.ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.first = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)  # what a byte begins as
        merges = [(raw(a), raw(b)) for a, b in pairs]
        self.ranks = {self.ids[a] << 32 | self.ids[b]: r for r, (a, b) in enumerate(merges)}
        self.joined = np.array([self.ids[a + b] for a, b in merges] or [0], np.int32)
        self._keys, self._ranks = _buckets(self.ranks)
        self.special = special
        self.bytes = {i: t for t, i in self.ids.items()} | {
            i: t.encode() for t, i in special.items()
        }
        self._cut = regex.compile("|".join(  # the longest at each place
            regex.escape(t) for t in sorted(special, key=len, reverse=True)
        )) if special else None
        self._words = _Words(self.merge_long)
        self._plain = regex.compile(_pattern(""))
        self._newer: tuple | None = None  # found when the first text beyond ASCII comes

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent parts; those of a missing part (-1) or without a merge are _NO_MERGE."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot, out = _slot(keys, len(self._keys[0])), np.full(keys.shape, _NO_MERGE, np.int32)
        for some, ranks in zip(self._keys, self._ranks, strict=True):
            np.copyto(out, ranks[slot], where=some[slot] == keys)
        return out

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids, as bytes of an int32 array, of words of one length, all in step."""
        width = len(words[0])
        parts = self.first[np.frombuffer(b"".join(words), np.uint8).reshape(-1, width)]
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        out: list[bytes] = [b""] * len(words)
        rows = np.arange(len(words))
        while True:
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            least = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NO_MERGE)
            if (done := least == _NO_MERGE).any():
                for row, ids in zip(rows[done].tolist(), parts[done], strict=True):
                    out[row] = ids.tobytes()
                keep = ~done
                rows, parts, ranks, at, least = rows[keep], parts[keep], ranks[keep], at[keep], least[keep]
            if not len(rows):
                return out
            each, column, place = np.arange(len(rows)), np.arange(parts.shape[1] - 1), at[:, None]
            joined = self.joined[least]
            parts = np.where(column <= place, parts[:, :-1], parts[:, 1:])  # the boundary is deleted
            parts[each, at] = joined
            ranks = np.where(column[:-1] < place, ranks[:, :-1], ranks[:, 1:])
            for near in (at - 1, at):
                has = (near >= 0) & (near < ranks.shape[1])
                row, i = each[has], near[has]
                ranks[row, i] = self._rank(parts[row, i], parts[row, i + 1])

    def learn(self, words) -> None:
        """Add the ids of words that are not known yet; long ones are not kept."""
        known = self._words
        if len(known) > CACHED_WORDS:
            known.clear()
        by_width: dict[int, list] = {}
        for word in words.difference(known):
            if not isinstance(word, int) and len(raw := word.encode()) <= SCAN_BYTES:
                by_width.setdefault(len(raw), []).append((word, raw))
        for group in by_width.values():
            for start in range(0, len(group), _TOGETHER):
                some = group[start : start + _TOGETHER]
                ids = self.merge_short([raw for _, raw in some])
                known.update(zip((word for word, _ in some), ids, strict=True))

    def merge_long(self, word: bytes) -> list[int]:
        """Ids of one word, the next merge from a heap."""
        n, rank, first, joined = len(word), self.ranks.get, self.first.tolist(), self.joined.tolist()
        part = [first[b] for b in word]  # by the place where it begins; -1: joined to the one before
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            if (b := after[a]) < n and (r := rank(part[a] << 32 | part[b])) is not None:
                heapq.heappush(heap, (r, a, part[a], part[b]))

        for a in range(n - 1):
            offer(a)
        while heap:
            r, a, left, right = heapq.heappop(heap)
            if part[a] != left or (b := after[a]) == n or part[b] != right:
                continue  # one of the two has been joined meanwhile
            part[a], part[b], after[a] = joined[r], -1, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [p for p in part if p >= 0]

    def _split(self, text: str) -> list:
        """The words of a text, and added tokens found in it as their ids."""
        if self._cut is None or not (found := [*self._cut.finditer(text)]):
            return self._find(text)
        out, last = [], 0
        for token in found:
            out += self._find(text[last : token.start()])
            out.append(self.special[token[0]])
            last = token.end()
        return out + self._find(text[last:])

    def _find(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII.findall(text)
        if self._newer is None:
            self._newer = _newer_characters()
        newer, exact = self._newer
        return (self._plain if newer.isdisjoint(set(text)) else exact).findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; added tokens found in a text are those tokens."""
        cut = [self._split(t) for t in texts]
        self.learn(set().union(*cut))
        ids = self._words.__getitem__
        return [np.frombuffer(b"".join(map(ids, c)), np.int32) for c in cut]

    def forget(self) -> None:
        """Drop the words remembered so far."""
        self._words.clear()

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        return b"".join([self.bytes.get(i, b"") for i in ids]).decode("utf-8", "replace")


class _Words(dict):
    """Word to its ids as the bytes of an int32 array; long words and numbers of added tokens on demand."""

    def __init__(self, merge_long):
        super().__init__()
        self.merge_long = merge_long

    def __missing__(self, word) -> bytes:
        return array("i", [word] if isinstance(word, int) else self.merge_long(word.encode())).tobytes()


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    """``slots`` is a power of two."""
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - slots.bit_length())


def _buckets(ranks: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The same map as arrays: keys and ranks by slot, as many rows as the fullest slot needs."""
    keys, values = np.array([*ranks], np.int64), np.array([*ranks.values()], np.int32)
    slots = 1 << max(4, (8 * len(keys)).bit_length())
    order = np.argsort(at := _slot(keys, slots), kind="stable")
    at, keys, values = at[order], keys[order], values[order]
    column = np.arange(len(at)) - np.searchsorted(at, at)
    shape = (int(column.max(initial=0)) + 1, slots)
    table, found = np.full(shape, -2, np.int64), np.full(shape, _NO_MERGE, np.int32)
    table[column, at], found[column, at] = keys, values
    return table, found


def _pattern(newer: str) -> str:
    if not newer:
        return _SPLIT
    letter, number = (rf"(?:(?![{newer}])\p{{{k}}})" for k in "LN")
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+"
        rf"| ?(?:[^\s\p{{L}}\p{{N}}]|[{newer}])+|\s+(?!\S)|\s+"
    )


def _newer_characters():
    """Letters and digits of a newer Unicode than the encoder library's, and the pattern without them.

    Found by asking that library's own splitter about each character that the
    Python runtime does not know yet.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    unknown = [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    mine = regex.findall(r"[\p{L}\p{N}]", "".join(unknown))
    newer = [c for c in mine if len(split(f"a{c}1{c}")) == 4]
    return frozenset(newer), regex.compile(_pattern("".join(newer)))


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text) as (id, ids)."""
    known = vocabulary(path)
    for batch in pieces(batches, "text", PIECE_BYTES):
        found = known.encode([t or "" for t in batch.column("text").to_pylist()])
        bounds = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("id"), list_array(flat, bounds)], ["id", "ids"])
    known.forget()


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches of (id, ids) as (id, ids, text)."""
    known = vocabulary(path)
    for batch in batches:
        lists = pc.fill_null(batch.column("ids"), pa.scalar([], pa.list_(pa.int32())))
        flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        texts = [known.decode(flat[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())], ["id", "ids", "text"]
        )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ids array<int>) per document, repeated rows included.

    Null and empty texts have no ids; a text of any length is encoded whole, and an empty
    table gives no rows. ``path`` is the vocabulary file's place on
    every executor. Other columns of the input are not read.
    """
    rows, kind = _texts(docs, id_col, text_col)
    return rows.mapInArrow(released(lambda batches: _encoded(batches, path)), f"id {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """One row (id, ids, text) per row of ids; null ids give an empty text, an empty table no rows."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(released(lambda batches: _decoded(batches, path)), f"id {kind}, ids array<int>, text string")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bpe_encode`` and then ``bpe_decode`` in the same tasks, with one vocabulary in memory."""
    rows, kind = _texts(docs, id_col, text_col)
    return rows.mapInArrow(
        released(lambda batches: _decoded(_encoded(batches, path), path)),
        f"id {kind}, ids array<int>, text string",
    )
