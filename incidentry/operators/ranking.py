"""Top-k reports. Every ranking ends in a tie-break, so results are repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import count_by


def top_k(
    df: DataFrame,
    by: str | Column,
    k: int,
    ties: Sequence[str],
    min_support: tuple[str, int] | None = None,
) -> DataFrame:
    """The ``k`` largest rows by one column; ``min_support=("Count", 100)`` first
    drops rows whose Count is 100 or less."""
    if min_support is not None:
        column, least = min_support
        df = df.filter(F.col(column) > F.lit(least))
    order = F.col(by) if isinstance(by, str) else by
    return df.orderBy(order.desc(), *[F.col(t).asc() for t in ties]).limit(k)


def top_group_peaks(
    df: DataFrame, group: str, day: str, k_groups: int = 10, k_days: int = 12,
    weight: str | None = None,
) -> DataFrame:
    """The busiest ``(day, group)`` pairs among the ``k_groups`` largest groups.

    Both rankings come from the same daily counts, so the fact table is read
    and shuffled once. Rows without a group belong to none. The adaptive plan
    measures the leaders and chooses how to join them.
    """
    daily = count_by(df.filter(F.col(group).isNotNull()), [day, group], weight=weight)
    leaders = top_k(count_by(daily, [group], weight="count"), "count", k_groups, [group])
    leaders = leaders.select(F.col(group).alias("_leader"))
    among = daily.join(leaders, F.col(group) == F.col("_leader")).drop("_leader")
    return top_k(among, "count", k_days, [day, group])


def attach_attribute(
    peaks: DataFrame, df: DataFrame, keys: Sequence[str], attributes: Sequence[str],
    day: str | None = None, partition: str | None = None,
) -> DataFrame:
    """One row per fact row on a ranked key, with the listed fact columns.

    Stage the ranking first: Spark then knows how small it is and does not
    shuffle the fact table. With the fact table's year ``partition`` and the
    ``day`` among the keys, only folders from the year before the first ranked day
    to the one after the last are opened (in another time zone a year begins
    in its neighbour's folder); their bounds are read from the ranking when the query runs.
    """
    if partition is not None:
        first = peaks.agg(F.year(F.min(day)) - F.lit(1)).scalar()
        last = peaks.agg(F.year(F.max(day)) + F.lit(1)).scalar()
        df = df.filter(F.col(partition).between(first, last))
    return df.select(*keys, *attributes).join(peaks, list(keys))


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*order).limit(n)
