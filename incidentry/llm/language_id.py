"""Language identification by a byte convolutional network in numpy.

Filters of several widths slide over the bytes of fixed-length windows; each
keeps its maximum in the window, and a softmax layer turns the maxima into
language probabilities. A document's probabilities are the mean over all its
windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentry.sources.workspace import stage

from .common import free_name, pieces, released, text_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_ROWS = 500  # labelled documents of each language that training sees at most
SAMPLE_WINDOWS = 4  # pieces of each of them, spread over its text
UNKNOWN = "und"
_BATCH = 512  # windows convolved at once


@dataclass(frozen=True)
class ByteNetwork:
    """``filters[w]`` holds a weight for each place, byte and filter of width w."""

    languages: tuple[str, ...]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def predictor(self):
        """Function from windows (n x WINDOW bytes) to probabilities (n x languages).

        Weights of two adjacent bytes are added up beforehand, so that a filter
        reads one table row for each two bytes.
        """
        pairs = {}
        for width, table in self.filters.items():
            pairs[width] = [
                (table[k][:, None] + table[k + 1][None, :]).reshape(65536, -1) if k + 1 < width else table[k]
                for k in range(0, width, 2)
            ]

        def predict(windows: np.ndarray) -> np.ndarray:
            out = []
            for start in range(0, len(windows), _BATCH):
                some = windows[start : start + _BATCH]
                two = some[:, :-1].astype(np.int64) << 8 | some[:, 1:]
                pooled = []
                for width, tables in pairs.items():
                    places = WINDOW - width + 1
                    total = None
                    for step, table in enumerate(tables):
                        k = 2 * step
                        at = (two if len(table) == 65536 else some)[:, k : k + places]
                        part = table.take(at, axis=0)
                        total = part if total is None else np.add(total, part, out=total)
                    pooled.append(total.max(1))
                out.append(_softmax(self._hidden(np.concatenate(pooled, 1)) @ self.weights + self.offset))
            return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

        return predict

    def _hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0)


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(1, keepdims=True))
    return scores / scores.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: list[str], epochs: int = 8, seed: int = 11) -> ByteNetwork:
    """Fit the network by Adagrad on the cross entropy; a maximum passes its gradient to its place."""
    languages = tuple(sorted(set(labels)))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    filters = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
    weights = rng.normal(0, 0.2, (len(bias), len(languages))).astype(np.float32)
    offset = np.zeros(len(languages), np.float32)
    seen = {w: np.full(t.shape, 1e-3, np.float32) for w, t in filters.items()}
    other = [np.full(x.shape, 1e-3, np.float32) for x in (bias, weights, offset)]
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), 64):
            pick = order[start : start + 64]
            some, each = windows[pick], np.arange(len(pick))
            pooled, where = [], []
            for w in WIDTHS:
                places = WINDOW - w + 1
                total = sum(filters[w][k][some[:, k : k + places]] for k in range(w))
                where.append(total.argmax(1))
                pooled.append(np.take_along_axis(total, where[-1][:, None], 1)[:, 0])
            raw = np.concatenate(pooled, 1) + bias
            hidden = np.maximum(raw, 0)
            wrong = _softmax(hidden @ weights + offset)
            wrong[each, target[pick]] -= 1
            wrong /= len(pick)
            back = wrong @ weights.T * (raw > 0)
            for value, slope, past in zip(
                (bias, weights, offset), (back.sum(0), hidden.T @ wrong, wrong.sum(0)), other, strict=True
            ):
                past += slope * slope
                value -= 0.05 * slope / np.sqrt(past)
            for n, w in enumerate(WIDTHS):
                slope = np.zeros_like(filters[w])
                part = back[:, n * FILTERS : (n + 1) * FILTERS]
                for k in range(w):
                    at = some[each[:, None], where[n] + k]
                    np.add.at(slope[k], (at, np.arange(FILTERS)[None, :]), part)
                seen[w] += slope * slope
                filters[w] -= 0.05 * slope / np.sqrt(seen[w])
    return ByteNetwork(languages, filters, bias, weights, offset)


def cut_windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows' bytes as zero-padded windows, with each one's row and number of bytes."""
    lengths = np.diff(bounds)
    counts = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[:-1][row] + number * WINDOW
    size = np.minimum(bounds[1:][row] - starts, WINDOW)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts].copy()
    windows[np.arange(WINDOW)[None, :] >= size[:, None]] = 0
    return windows, row, size


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of training: crc32 of its id as text leaves 1 modulo 3."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def _least_hashes(docs: DataFrame, sizes: dict, rows: int) -> DataFrame:
    """Of each language the ``rows`` documents of least hash, and not many more, one row per id.

    Hashes are even, so a language's number of rows tells below which limit about so many lie. Where fewer are
    found there, as ids repeat or texts have no letter, the limit is raised.
    """
    spark, kind = docs.sparkSession, docs.schema["lang"].dataType
    share = {lang: min(1.0, (rows + 8 * rows**0.5 + 16) / n) for lang, n in sizes.items()}
    parts, missing = [docs.limit(0).select("lang", "id", "hash", "text")], set(sizes)
    while missing:
        limits = [(lang, min(int(share[lang] * (1 << 64)), (1 << 64) - 1) - (1 << 63)) for lang in missing]
        limits = spark.createDataFrame(limits, T.StructType().add("lang", kind).add("limit", "long"))
        below = docs.join(F.broadcast(limits), "lang").where("hash <= limit")  # a row per language
        found = stage(below.groupBy("lang", "id", "hash").agg(F.min("text").alias("text")), "language-sample")
        counts = {r["lang"]: r["n"] for r in found.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        few = {lang for lang in missing if share[lang] < 1.0 and counts.get(lang, 0) < rows}
        share |= {lang: min(1.0, 4 * share[lang]) for lang in few}
        parts.append(found.where(F.col("lang").isin(list(missing - few))))
        missing = few
    return reduce(DataFrame.union, parts)


def fit_language_id(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    rows: int = SAMPLE_ROWS, windows: int = SAMPLE_WINDOWS,
) -> ByteNetwork | None:
    """Train on at most ``rows`` documents of each language, those with the least hashes of their ids.

    Only documents that are not held out, with a language, an id and a letter in
    the text are learned from, and of each at most ``windows`` pieces of
    ``WINDOW`` characters, so what the driver gets is bounded. Rows that share language
    and id count once, by the least of their pieces. None without such documents.
    """
    step = F.greatest((F.length("text") - WINDOW) / F.lit(max(windows - 1, 1)), F.lit(0.0))
    labelled = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
    pieces_of = labelled.where(_has_letter("text")).select(
        "lang", "id", F.xxhash64("id", F.lit(5)).alias("hash"),
        F.array(*[F.substr("text", (F.lit(1) + step * k).cast("int"), F.lit(WINDOW)) for k in range(windows)])
        .alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "id"))
    chosen = (
        _least_hashes(pieces_of, {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}, rows)
        .withColumn("place", place)
        .where(F.col("place") <= rows)
        .select("lang", F.explode(F.array_distinct("text")).alias("piece"))
        .orderBy("lang", "piece")
        .collect()
    )
    if not chosen:
        return None
    raw = [r["piece"].encode()[:WINDOW] for r in chosen]
    grid = np.zeros((len(raw), WINDOW), np.uint8)
    for line, piece in zip(grid, raw, strict=True):
        line[: len(piece)] = np.frombuffer(piece, np.uint8)
    return train(grid, [r["lang"] for r in chosen])


def _has_letter(name: str) -> Column:
    return F.coalesce(F.col(name).rlike(r"\p{L}"), F.lit(False))


def predict_language(
    docs: DataFrame, model: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Append lang_pred and score to every row; a column of the input so named (in any case) is replaced.

    Null texts, and texts without a letter, are ``und`` with score 1; all are
    ``und`` with score 0 without a model. Windows cover the whole text.
    """
    kept = docs.drop("lang_pred", "score")
    own = free_name(kept, "__text")
    rows = kept.withColumn(own, _has_letter(text_col))  # the text itself goes to Python once
    names = [f.name for f in kept.schema]
    text = next(f for f in kept.schema if f.name.lower() == text_col.lower())
    if not isinstance(text.dataType, T.StringType):
        raise TypeError(f"{text_col} must be text")
    if model is None:
        return kept.withColumns(
            {"lang_pred": F.lit(UNKNOWN), "score": F.when(_has_letter(text_col), 0.0).otherwise(1.0)}
        )
    out_schema = T.StructType([*kept.schema]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = model.predictor()
        languages = np.array(model.languages, object)
        for batch in pieces(batches, text.name, 1 << 20):
            data, bounds = text_of(batch.column(text.name))
            windows, row, size = cut_windows(data, bounds)
            lettered = batch.column(own).to_numpy(zero_copy_only=False).astype(bool)[row]
            windows, row, size = windows[lettered], row[lettered], size[lettered]
            likely = np.zeros((batch.num_rows, len(languages)))
            np.add.at(likely, row, predict(windows) * size[:, None])
            total = likely.sum(1)
            known = total > 0
            best = likely.argmax(1)
            score = np.ones(batch.num_rows)
            score[known] = np.clip(likely[known, best[known]] / total[known], 0, 1)
            found = np.where(known, languages[best], UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(found, pa.string()), pa.array(score)],
                [*names, "lang_pred", "score"],
            )

    return rows.mapInArrow(released(run), out_schema)
