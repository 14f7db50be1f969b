"""Flags, ratios, cell numbers and map coordinates as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed value: equatorial radius of the Web-Mercator sphere, in metres.
EARTH_RADIUS = 6378137.0


def any_flag(df: DataFrame, flags: Sequence[str], out: str) -> DataFrame:
    """True when at least one flag is true; null flags count as false."""
    return df.withColumn(out, F.coalesce(reduce(or_, map(F.col, flags)), F.lit(False)))


def flags_to_int(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Cast the listed columns to int and keep the others as they are."""
    wanted = set(flags)
    return df.select([F.col(c).cast("int").alias(c) if c in wanted else F.col(c) for c in df.columns])


def web_mercator(
    df: DataFrame, lon: str, lat: str, x: str = "merc_x", y: str = "merc_y"
) -> DataFrame:
    """Add Web-Mercator metres for a longitude and latitude in degrees."""
    half_angle = F.lit(0.7853981633974483) + F.radians(F.col(lat)) / F.lit(2.0)
    return df.withColumns(
        {
            x: F.lit(EARTH_RADIUS) * F.radians(F.col(lon)),
            y: F.lit(EARTH_RADIUS) * F.log(F.tan(half_angle)),
        }
    )


def scaled(df: DataFrame, column: str, factor: float, out: str) -> DataFrame:
    """Add a measure multiplied by a constant."""
    return df.withColumn(out, F.col(column) * F.lit(factor))


def constant(df: DataFrame, out: str, value) -> DataFrame:
    """Add a constant column."""
    return df.withColumn(out, F.lit(value))


def ratio(top: str | Column, bottom: str | Column, digits: int | None = None) -> Column:
    """top / bottom, null where bottom is zero; optionally rounded."""
    value = F.try_divide(
        F.col(top) if isinstance(top, str) else top,
        F.col(bottom) if isinstance(bottom, str) else bottom,
    )
    return value if digits is None else F.round(value, digits)


def cell(value: str, lo: float, width: float) -> Column:
    """Number of the fixed-width cell a value falls in, counted from ``lo``."""
    return F.floor((F.col(value) - F.lit(lo)) / F.lit(width)).cast("bigint")


def is_floating(df: DataFrame, column: str) -> bool:
    # The exact name is looked up at once; another spelling is left to Spark.
    known = [f.dataType for f in df.schema if f.name == column]
    kind = known[0] if len(known) == 1 else df.select(F.col(column)).schema[0].dataType
    return isinstance(kind, (FloatType, DoubleType))


def real_value(df: DataFrame, column: str) -> Column:
    """The column with NaN turned into null. Mentions the column once, so that
    nested uses do not multiply the work of computing it."""
    value = F.col(column)
    return F.nanvl(value, F.lit(None)) if is_floating(df, column) else value
