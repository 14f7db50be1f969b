"""Where accidents happen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import count_by, summarise, value_bounds
from ..operators.cleaning import baseline
from ..operators.profile import series, share
from ..operators.ranking import top_k
from ..operators.rates import rate_by_dimension
from ..sources.rollups import YearlyRollups
from .clean import rolled_up, year_partition


def address_rollup(incidents: DataFrame, before_year: int = 2020) -> DataFrame:
    """Accidents per severity, side, city, state and timezone; all reports below
    are sums over this table."""
    rows = baseline(
        incidents, "Start_Time", "Severity", before_year, partition=year_partition(incidents)
    )
    return count_by(rows, ["Severity", "Side", "City", "State", "Timezone"], out="n")


def side_and_severity(rollup: DataFrame) -> DataFrame:
    return count_by(rollup, ["Side", "Severity"], out="Count", weight="n").orderBy("Severity", "Side")


def _largest(rollup: DataFrame, key: str, digits: int, k: int = 10) -> DataFrame:
    placed = rollup.filter(F.col(key).isNotNull())  # rows without a place are in no ranking
    summary = summarise(placed, [key], "Severity", digits, average="AvgSeverity", weight="n")
    return top_k(summary, "Count", k, [key])


def city_count(rollup: DataFrame) -> DataFrame:
    return _largest(rollup, "City", 2)


def state_count(rollup: DataFrame, population: DataFrame) -> DataFrame:
    """The ten states with most accidents, per head of population."""
    return rate_by_dimension(
        _largest(rollup, "State", 2), population, ("State", "state"), "Count", "pop",
        out="AccidentsPerPerson",
    )


def city_average(rollup: DataFrame, more_than: int = 100, k: int = 10) -> DataFrame:
    """The cities with the worst average severity among those with enough accidents.

    Ranked by the exact average; only the shown value is rounded.
    """
    placed = rollup.filter(F.col("City").isNotNull())
    summary = summarise(placed, ["City"], "Severity", weight="n")
    worst = top_k(summary, "Avg", k, ["City"], min_support=("Count", more_than))
    return worst.select("City", "Count", F.round("Avg", 3).alias("AvgSeverity"))


def timezone_summary(rollup: DataFrame) -> DataFrame:
    return _largest(rollup, "Timezone", 3)


def address_reports(
    incidents: DataFrame, population: DataFrame, before_year: int = 2020,
    stage=lambda df, label: df, kept: YearlyRollups | None = None,
) -> dict[str, DataFrame]:
    """All reports on location."""
    rollup = rolled_up(
        incidents, stage, kept, lambda rows: address_rollup(rows, before_year), "address", before_year
    )
    sides = side_and_severity(rollup)
    return {
        "SideAndSeverityCount": sides,
        "LeftSide": series(sides, "Side", "L", ["Severity"]),
        "RightSide": series(sides, "Side", "R", ["Severity"]),
        "CityCountBounds": value_bounds(city_count(rollup), "Count"),
        "CityAvgBounds": value_bounds(city_average(rollup), "AvgSeverity"),
        "CityCount": city_count(rollup),
        "StateCount": state_count(rollup, population),
        "CityAvg": city_average(rollup),
        "Timezone": timezone_summary(rollup),
        "TimezoneShare": share(timezone_summary(rollup), "Count").select("Timezone", "share"),
    }
