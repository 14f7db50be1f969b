"""Counts, averages and totals.

``weight`` names a column holding how many source rows a row stands for, so
the same operators work on a fact table (no weight) and on a roll-up of it.
Reports that share a fact table aggregate it once and go on from there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import real_value


def _rows(weight: str | None, condition: Column | None = None) -> Column:
    if weight is None:
        return F.count("*") if condition is None else F.count_if(condition)
    part = F.col(weight) if condition is None else F.when(condition, F.col(weight)).otherwise(F.lit(0))
    return F.sum(part)


def count_by(
    df: DataFrame, keys: Sequence[str], out: str = "count", weight: str | None = None
) -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(_rows(weight).alias(out))


def summarise(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    digits: int | None = None,
    count: str = "Count",
    average: str = "Avg",
    weight: str | None = None,
) -> DataFrame:
    """Non-null count and average of a measure per key, the average rounded on request."""
    value = F.col(measure)
    if weight is None:
        counted, mean = F.count(value), F.avg(value)
    else:
        counted = _rows(weight, value.isNotNull())
        mean = F.try_divide(F.sum(value * F.col(weight)), counted)
    if digits is not None:
        mean = F.round(mean, digits)
    return df.groupBy(*keys).agg(counted.alias(count), mean.alias(average))


def average_by(
    df: DataFrame, keys: Sequence[str], measure: str, at_least: float | None = None,
    out: str = "average",
) -> DataFrame:
    """Average of a measure per key, ignoring NaN and values under ``at_least``."""
    value = real_value(df, measure)
    kept = df if at_least is None else df.filter(value >= F.lit(at_least))
    return kept.groupBy(*keys).agg(F.avg(value).alias(out))


def average_and_max(
    df: DataFrame, keys: Sequence[str], measure: str, digits: int = 1
) -> DataFrame:
    """Rounded average and maximum of a measure per key; NaN is missing."""
    value = real_value(df, measure)
    return df.groupBy(*keys).agg(
        F.round(F.avg(value), digits).alias(f"avg_{measure}"),
        F.max(value).alias(f"max_{measure}"),
    )


def flag_totals(
    df: DataFrame,
    flags: Sequence[str],
    keys: Sequence[str] = (),
    weight: str | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """How many rows carry each flag, overall or per key, one column per flag."""
    names = names or {}
    unit = F.lit(1) if weight is None else F.col(weight)
    totals = [F.sum(F.col(f).cast("int") * unit).alias(names.get(f, f)) for f in flags]
    return df.groupBy(*keys).agg(*totals)


def value_bounds(
    df: DataFrame, column: str, low: float = 0.9, high: float = 1.1
) -> DataFrame:
    """Axis bounds of a column: its minimum and maximum with a margin; NaN is missing."""
    value = real_value(df, column)
    return df.agg(
        (F.min(value) * F.lit(low)).alias("lower_bound"),
        (F.max(value) * F.lit(high)).alias("upper_bound"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the listed columns."""
    return df.select(*columns).distinct()


def cohort_compare(
    df: DataFrame,
    key: str,
    cohorts: Mapping[str, Column],
    weight: str | None = None,
) -> DataFrame:
    """Row counts of several cohorts side by side per key, from one scan.

    A key that some cohort lacks is left out, as if each cohort had been
    counted on its own and the counts joined. ``cohorts`` maps the output
    column to the cohort's condition.
    """
    counts = [_rows(weight, condition).alias(name) for name, condition in cohorts.items()]
    wide = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*counts)
    for name in cohorts:
        wide = wide.filter(F.col(name) > 0)
    return wide
