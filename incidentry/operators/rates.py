"""Rates against a dimension table.

Facts are counted per key before they meet the dimension. No join here is
hinted: Spark broadcasts the dimension when its measured size is under the
session's threshold and sorts and merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from .aggregate import count_by


def rate_by_dimension(
    counts: DataFrame, dim: DataFrame, on: tuple[str, str], count: str, size: str,
    out: str = "rate", digits: int | None = None,
) -> DataFrame:
    """Attach a dimension's size column to counts and divide by it.

    ``on`` names the key in ``counts`` and in ``dim``. A size of zero gives a
    null rate, keys the dimension lacks are left out.
    """
    left, right = on
    side = dim.select(F.col(right).alias("_dim_key"), F.col(size))
    joined = counts.join(side, F.col(left) == F.col("_dim_key")).drop("_dim_key")
    return joined.withColumn(out, ratio(count, size, digits))


def two_level_rate(
    df: DataFrame,
    key: str,
    sizes: DataFrame,
    groups: DataFrame,
    dim_key: str,
    group: str,
    size: str,
    digits: int = 6,
    weight: str | None = None,
) -> DataFrame:
    """Events per head of each group of keys (accidents per capita by colour).

    ``sizes`` is ``(dim_key, size)`` and ``groups`` is ``(dim_key, group)``.
    Output columns: the group, ``total_<size>``, ``total_count`` and ``rate``.
    """
    member = groups.select(F.col(dim_key).alias("_key"), F.col(group))
    per_key = count_by(df, [key], out="_n", weight=weight)
    events = (
        per_key.join(member, F.col(key) == F.col("_key"))
        .groupBy(group)
        .agg(F.sum("_n").alias("total_count"))
    )
    heads = (
        sizes.select(F.col(dim_key).alias("_size_key"), F.col(size))
        .join(member, F.col("_size_key") == F.col("_key"))
        .groupBy(group)
        .agg(F.sum(size).alias(f"total_{size}"))
    )
    return heads.join(events, group).withColumn(
        "rate", ratio("total_count", f"total_{size}", digits)
    )
