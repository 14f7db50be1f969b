"""Class rebalancing and splits.

Rows are decided by ``md5(seed|identity)``: the same rows come out whatever the
partitioning and after lost tasks. A row's identity is its key. Where the key is
missing, or ``WHOLE_ROW`` is given instead of one, it is a digest of all columns
and a running number among equal rows. Without a key, undersampling and splits use Spark's own
samplers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, TimestampType, VariantType

from ..sources.workspace import stage
from .aggregate import count_by

WHOLE_ROW = "*"
_IDENTITY = "_identity"
_EQUAL_AT_ONCE = 100_000  # equal rows numbered by one task
_MEAN_AT_ONCE = 16  # copies drawn at once are a Poisson number of this mean at most
_MOST_AT_ONCE = 80  # more copies than this at once have a probability below 1e-25
_COPIES_AT_ONCE = 10_000  # a row needed more often is copied in portions of so many


def unit_hash(key: str, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) for each text of the column; null counts as empty."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    first = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10)
    return first.cast("double") / F.lit(4294967296.0)


def _text(name: str, kind: DataType) -> Column:
    """The column as text that differs wherever values do, 0.0 and -0.0 included."""
    column = F.col(f"`{name}`")
    if isinstance(kind, BinaryType):
        return F.hex(column)
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        return F.to_json(F.struct(column), {"ignoreNullFields": "false"})
    return column.cast("string")


def _numbered(df: DataFrame) -> DataFrame:
    """Rows with the digest of their columns and their number among equal rows.

    Equal rows are counted, which combines before the shuffle, and written out again in portions.
    """
    row = F.to_json(F.struct(*[_text(f.name, f.dataType).alias(f"c{i}") for i, f in enumerate(df.schema)]), {"ignoreNullFields": "false"})
    counted = df.select(F.sha2(row, 256).alias("_digest"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    counted = counted.groupBy("_digest").agg(F.first("_row").alias("_row"), F.count("*").alias("_times"))
    last = F.floor((F.col("_times") - 1) / _EQUAL_AT_ONCE)
    portions = counted.withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("_portion") * _EQUAL_AT_ONCE
    end = F.least(start + _EQUAL_AT_ONCE, F.col("_times")) - 1
    return portions.hint("rebalance", F.col("_digest"), F.col("_portion")).withColumn(
        "_number", F.explode(F.sequence(start, end))
    ).select("_row.*", F.concat_ws("#", "_digest", "_number").alias(_IDENTITY))


def identified(df: DataFrame, key: str) -> DataFrame:
    """The rows with their identity as one more column.

    Rows that share a key share their fate, so copies of a row never end on both
    sides of a split. Only rows without a key (which a scan finds by its statistics) are
    grouped; with ``WHOLE_ROW`` all are.
    """
    if key == WHOLE_ROW:
        return _numbered(df)
    keyed = df.filter(F.col(key).isNotNull()).withColumn(_IDENTITY, F.col(key).cast("string"))
    if not df.select(F.col(key)).schema[0].nullable:
        return keyed
    return keyed.unionByName(_numbered(df.filter(F.col(key).isNull())))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, as a frame."""
    return count_by(df, [label])


def undersample(
    df: DataFrame, label: str, fractions: Mapping[object, float], key: str | None = None,
    seed: int = 10,
) -> DataFrame:
    """Keep a fraction of each class; a class not listed is dropped, and so are rows without a class.

    With a ``key`` (or ``WHOLE_ROW``) rows are chosen by the hash of their identity, otherwise at random.
    """
    if key is None:
        return df.sampleBy(label, fractions=dict(fractions), seed=seed)
    part = F.lit(0.0)
    for value, fraction in fractions.items():
        part = F.when(F.col(label) == F.lit(value), F.lit(float(fraction))).otherwise(part)
    return identified(df, key).filter(unit_hash(_IDENTITY, seed) < part).drop(_IDENTITY)


def oversample(df: DataFrame, label: str, key: str, seed: int = 10) -> DataFrame:
    """Repeat rows until each class is about as large as the largest one.

    A class short by the ratio r gets floor(r) copies of every row and one more
    of the rows whose hash is under r's fraction. All classes are handled in one
    pass; the class sizes are staged, so Spark knows how small they are and
    joins them without shuffling the table, however uneven the classes. Rows
    without a class are kept once. Rows needed very often are copied in portions,
    which a rebalance spreads over tasks.
    """
    ratios = _ratios(df.filter(F.col(label).isNotNull()), label)
    extra = unit_hash(_IDENTITY, seed) < F.col("_ratio") - F.floor("_ratio")
    copies = F.floor("_ratio") + extra.cast("int")
    counted = identified(df, key).join(ratios, F.col(label) == F.col("_label"), "left").withColumn(
        "_copies", F.coalesce(copies, F.lit(1))
    )
    portions = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / _COPIES_AT_ONCE))
    rest = F.col("_copies") - F.col("_portion") * _COPIES_AT_ONCE
    counted = (
        counted.withColumn("_portion", F.explode(portions))
        .withColumn("_copies", F.least(rest, F.lit(_COPIES_AT_ONCE)))
        .hint("rebalance", F.col(_IDENTITY), F.col("_portion"))
    )
    return _repeated(counted, df.columns)


def _ratios(df: DataFrame, label: str) -> DataFrame:
    """How many times each class would have to be repeated to be as large as the largest: staged, so of known size."""
    sizes = stage(class_counts(df, label), "classes")
    largest = sizes.agg(F.max("count")).scalar()
    return sizes.select(F.col(label).alias("_label"), (largest / F.col("count")).alias("_ratio"))


def _repeated(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row ``_copies`` times."""
    repeated = F.explode(F.array_repeat(F.lit(True), F.col("_copies").cast("int")))
    return counted.withColumn("_copy", repeated).select(*[F.col(f"`{c}`") for c in columns])


def oversample_random(
    df: DataFrame, label: str, classes: Sequence[object], seed: int = 10, key: str = WHOLE_ROW
) -> DataFrame:
    """Draw every listed class with replacement up to the size of the largest
    one, whose rows stay as they are; rows of other classes are dropped.

    Drawing with replacement gives each row a Poisson number of copies. That
    number is read off the Poisson distribution at the hash of the row's identity, so it
    is the same after any repartitioning or lost task, and all classes are drawn
    in one pass. A large mean is drawn as a sum of smaller ones, in portions
    spread over tasks. Give a ``key`` where there is one: whole rows must be shuffled to number equal ones.
    """
    listed = df.filter(F.col(label).isin(list(classes)))
    portions = F.ceil(F.col("_ratio") / _MEAN_AT_ONCE)
    mean = F.col("_ratio") / F.col("_portions")
    first = F.exp(-mean)
    start = F.struct(F.array(first).alias("upto"), first.alias("here"))

    def step(state: Column, k: Column) -> Column:
        here = state["here"] * mean / k
        return F.struct(F.array_append(state["upto"], F.element_at(state["upto"], -1) + here).alias("upto"), here.alias("here"))

    upto = F.aggregate(F.sequence(F.lit(1), F.lit(_MOST_AT_ONCE)), start, step, lambda state: state["upto"])
    drawn = _ratios(listed, label).withColumn("_portions", portions).select(
        "_label", F.sequence(F.lit(1).cast("bigint"), "_portions").alias("_every"), F.when(F.col("_ratio") > 1, upto).alias("_upto")
    )
    spread = (
        identified(listed, key).join(stage(drawn, "drawn"), F.col(label) == F.col("_label"))
        .withColumn("_portion", F.explode("_every"))
        .withColumn("_draw", F.concat_ws("|", _IDENTITY, "_portion"))
        .withColumn("_at", unit_hash("_draw", seed))
    )
    number = F.coalesce(F.size(F.filter("_upto", lambda p: p <= F.col("_at"))), F.lit(1))
    copies = F.when(F.col("_upto").isNull(), F.lit(1)).otherwise(number)
    return _repeated(spread.withColumn("_copies", copies), df.columns)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """The rows with a weight that makes all classes count alike, in place of copies.

    A row of the largest class, and one without a class, weighs 1.
    """
    ratios = _ratios(df.filter(F.col(label).isNotNull()), label)
    weighed = df.join(ratios, F.col(label) == F.col("_label"), "left")
    return weighed.withColumn(out, F.coalesce("_ratio", F.lit(1.0))).drop("_label", "_ratio")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def split(
    df: DataFrame, fraction: float = 0.8, key: str | None = None, seed: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows: by the hash of their identity, or at random without a key."""
    if key is None:
        train, test = df.randomSplit([fraction, 1.0 - fraction], seed)
        return train, test
    rows = identified(df, key)
    below = unit_hash(_IDENTITY, seed) < F.lit(fraction)
    return rows.filter(below).drop(_IDENTITY), rows.filter(~below).drop(_IDENTITY)
