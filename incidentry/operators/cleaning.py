"""Row filters, sentinels and missing values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import before_year, outside_year, within_years
from ..functions.columns import is_floating, real_value


def baseline(
    df: DataFrame, ts: str, ordinal: str, year: int, shift: int = 1, partition: str | None = None
) -> DataFrame:
    """The shared row filter: before ``year``, with the ordinal moved down by ``shift``."""
    kept = df.filter(before_year(df, ts, year))
    if partition is not None:
        kept = kept.filter(F.col(partition) <= F.lit(year))
    return kept.withColumn(ordinal, F.col(ordinal) - F.lit(shift))


def in_years(
    df: DataFrame, ts: str, years: Iterable[int], partition: str | None = None
) -> DataFrame:
    """Rows of the given years.

    ``partition`` names the table's year partition column, if it has one;
    folders of other years are then never opened. The folders of both
    neighbouring years are, since a year begins at another instant in another
    time zone; the timestamp decides.
    """
    years = sorted(set(years))
    kept = df.filter(within_years(df, ts, years))
    near = sorted({y + d for y in years for d in (-1, 0, 1)})
    return kept if partition is None else kept.filter(F.col(partition).isin(near))


def not_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows of every other year; rows without a timestamp are dropped too.

    The year's own folder, if the table has one, is read as well: in another
    time zone than the writer's it holds rows of the neighbouring years.
    """
    return df.filter(outside_year(df, ts, year))


def keep_above(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Rows whose listed columns all exceed their threshold; NaN does not."""
    above = [F.col(c) > F.lit(t) for c, t in thresholds.items()]
    above += [~F.isnan(c) for c in thresholds if is_floating(df, c)]
    return df.filter(reduce(and_, above))


def drop_sentinels(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Rows with a real value (no null, NaN or sentinel) in every listed column."""
    # A null fails the comparison; only NaN passes it and needs its own test.
    known = [F.col(c) != F.lit(s) for c, s in sentinels.items()]
    known += [~F.isnan(c) for c in sentinels if is_floating(df, c)]
    return df.filter(reduce(and_, known))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace missing values by a per-column default, cast to the column's type."""
    unknown = set(defaults) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    filled = {
        c: F.coalesce(real_value(df, c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in defaults.items()
    }
    return df.withColumns(filled)


def strip_chars(df: DataFrame, column: str, pattern: str = r"\\", out: str | None = None) -> DataFrame:
    """Remove every match of a pattern; backslashes unless told otherwise."""
    return df.withColumn(out or column, F.regexp_replace(F.col(column), pattern, ""))


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` of the columns that miss values, in one pass."""
    columns = list(columns or df.columns)
    # Positional names, so that a column called "id" or "Distance(mi)" is no trouble.
    totals = df.agg(
        *[F.count_if(real_value(df, c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count"))
        for i, c in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*pairs))).filter("null_count > 0")
