"""Shares, pivots, histograms and map cells: what the charts draw."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cell, ratio, real_value


def share(
    counts: DataFrame, value: str, within: Sequence[str] = (), out: str = "share",
    digits: int | None = None,
) -> DataFrame:
    """Each row's part of the total, overall or within a category.

    Totals are aggregated and joined back rather than computed in a window, so
    neither all rows nor a hot category has to fit one task. The grand total is
    a scalar subquery.
    """
    if not within:
        total = counts.agg(F.sum(value)).scalar()
        return counts.withColumn(out, ratio(F.col(value), total, digits))
    totals = counts.groupBy(*[F.col(c).alias(f"_{c}") for c in within]).agg(
        F.sum(value).alias("_total")
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in within])
    joined = counts.join(totals, same).withColumn(out, ratio(value, "_total", digits))
    return joined.drop("_total", *[f"_{c}" for c in within])


def pivot_counts(
    df: DataFrame, rows: Sequence[str], cols: str, values: Mapping[object, str],
    weight: str | None = None,
) -> DataFrame:
    """One count column per listed value of ``cols`` (``{value: column name}``);
    combinations that never occur count 0."""
    unit = F.lit(1) if weight is None else F.col(weight)
    cells = [
        F.sum(F.when(F.col(cols) == F.lit(v), unit).otherwise(F.lit(0))).alias(name)
        for v, name in values.items()
    ]
    return df.groupBy(*rows).agg(*cells)


def flags_long(
    totals: DataFrame, flags: Sequence[str], keys: Sequence[str] = (),
    name: str = "flag", value: str = "count",
) -> DataFrame:
    """Turn one column per flag into ``(keys, flag, count)`` rows."""
    return totals.unpivot(list(keys), list(flags), name, value)


def series(df: DataFrame, column: str, value, order: Sequence[str]) -> DataFrame:
    """One chart series: the rows of one value, sorted."""
    return df.filter(F.col(column) == F.lit(value)).orderBy(*order)


def histogram(
    df: DataFrame, keys: Sequence[str], measure: str, lo: float, width: float,
    bin_column: str = "bin", out: str = "count",
) -> DataFrame:
    """Rows per key and fixed-width bin: the outline of a violin plot."""
    known = df.filter(real_value(df, measure).isNotNull())
    return known.groupBy(*keys, cell(measure, lo, width).alias(bin_column)).agg(
        F.count("*").alias(out)
    )


def geo_grid(
    df: DataFrame, lat: str, lon: str, size: float, keys: Sequence[str] = (),
    out: str = "count",
) -> DataFrame:
    """Points per map cell of ``size`` degrees, so a map stays small at any scale.

    A point without a latitude or longitude (null, NaN) is on no map.
    """
    known = df.filter(real_value(df, lat).isNotNull() & real_value(df, lon).isNotNull())
    return known.groupBy(
        *keys, cell(lat, 0.0, size).alias("lat_cell"), cell(lon, 0.0, size).alias("lon_cell")
    ).agg(F.count("*").alias(out))


# Fixed value: the latitude at which the square Web-Mercator map ends.
_MAP_EDGE = 85.05112877980659


def tile_pyramid(
    df: DataFrame, lat: str, lon: str, keys: Sequence[str] = (), coarsest: int = 4, finest: int = 12,
    out: str = "count",
) -> DataFrame:
    """Points per Web-Mercator tile at each zoom level: ``(keys, zoom, x, y, quadkey, count)``.

    A map draws one level, so it stays small at any number of points. Points are
    counted at the finest level, in one scan and shuffle, and these counts are
    summed upwards. Points beyond the map's edge (85 degrees north or south, 180 degrees east or
    west) count in its outermost tiles; one without a latitude or longitude
    (null, NaN, infinite) is on no map.
    """
    far, side = F.lit(float("inf")), F.lit(float(1 << finest))
    north, east = real_value(df, lat).cast("double"), real_value(df, lon).cast("double")
    known = df.filter((F.abs(north) < far) & (F.abs(east) < far))
    angle = F.radians(F.greatest(F.least(north, F.lit(_MAP_EDGE)), F.lit(-_MAP_EDGE)))
    across = (east + F.lit(180.0)) / F.lit(360.0)
    down = F.lit(0.5) - F.log((F.lit(1.0) + F.sin(angle)) / (F.lit(1.0) - F.sin(angle))) / F.lit(4 * math.pi)

    def tile(part: Column) -> Column:
        return F.greatest(F.least(F.floor(part * side), side - F.lit(1.0)), F.lit(0.0)).cast("int")

    cells = known.groupBy(*keys, tile(across).alias("_x"), tile(down).alias("_y")).agg(F.count("*").alias("_n"))
    levels = cells.withColumn("zoom", F.explode(F.sequence(F.lit(coarsest), F.lit(finest))))
    up = F.lit(finest) - F.col("zoom")
    counts = levels.groupBy(
        *keys, "zoom", F.call_function("shiftright", "_x", up).alias("x"), F.call_function("shiftright", "_y", up).alias("y")
    ).agg(F.sum("_n").alias(out))

    def digit(i: Column) -> Column:
        bit = [F.call_function("shiftright", c, i - F.lit(1)).bitwiseAND(F.lit(1)) for c in ("x", "y")]
        return (bit[0] + F.lit(2) * bit[1]).cast("string")

    quadkey = F.array_join(F.transform(F.sequence(F.col("zoom"), F.lit(1), F.lit(-1)), digit), "")
    return counts.select(*keys, "zoom", "x", "y", quadkey.alias("quadkey"), out)
