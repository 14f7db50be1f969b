"""Calendar features and year predicates.

Year predicates are written as ranges over the timestamp itself, because
``year(ts) = 2019`` cannot be pushed into a Parquet scan while a range can.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add date, year, month, day, hour and both weekday numberings of ``ts``."""
    t = F.col(ts)
    return df.withColumns(
        {
            "date": F.to_date(t),
            "year": F.year(t),
            "month": F.month(t),
            "day": F.dayofmonth(t),
            "hour": F.hour(t),
            "weekday_sunday1": F.dayofweek(t),
            "weekday_monday1": F.weekday(t) + F.lit(1),
        }
    )


def parse_timestamp(
    df: DataFrame, column: str, out: str | None = None, fmt: str | None = None
) -> DataFrame:
    """Parse text to a timestamp; unreadable text becomes null, also under ANSI."""
    text = F.col(column)
    parsed = F.try_to_timestamp(text) if fmt is None else F.try_to_timestamp(text, F.lit(fmt))
    return df.withColumn(out or column, parsed)


def _year_start(df: DataFrame, ts: str, year: int) -> Column:
    kind = df.select(ts).schema[0].dataType
    if not isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        raise TypeError(f"{ts} is {kind.simpleString()}; parse it to a timestamp first")
    return F.lit(f"{year:04d}-01-01 00:00:00").cast(kind)


def before_year(df: DataFrame, ts: str, year: int) -> Column:
    """Condition: ``ts`` lies before the given year. A null timestamp fails it."""
    return F.col(ts) < _year_start(df, ts, year)


def outside_year(df: DataFrame, ts: str, year: int) -> Column:
    """Condition: ``ts`` lies in another year. A null timestamp fails it."""
    t = F.col(ts)
    return (t < _year_start(df, ts, year)) | (t >= _year_start(df, ts, year + 1))


def within_years(df: DataFrame, ts: str, years: Iterable[int]) -> Column:
    """Condition: ``ts`` lies in one of ``years``; neighbouring years make one range."""
    runs: list[list[int]] = []
    for year in sorted(set(years)):
        if runs and runs[-1][1] == year:
            runs[-1][1] = year + 1
        else:
            runs.append([year, year + 1])
    if not runs:
        return F.lit(False)
    t = F.col(ts)
    return reduce(
        or_,
        [(t >= _year_start(df, ts, a)) & (t < _year_start(df, ts, b)) for a, b in runs],
    )
