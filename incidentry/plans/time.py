"""When accidents happen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.calendar import parse_timestamp
from ..operators.aggregate import cohort_compare, count_by
from ..operators.cleaning import in_years
from ..operators.ranking import attach_attribute, top_group_peaks, top_k
from ..operators.rates import two_level_rate
from ..sources.rollups import YearlyRollups
from .clean import rolled_up, year_partition

YEARS = (2017, 2018, 2019)
EASTERN = "US/Eastern"


def _band(north: float, south: float):
    lat = F.col("Start_Lat")
    return F.when(lat > F.lit(north), "north").when(lat < F.lit(south), "south").otherwise("middle")


def calendar_rollup(
    incidents: DataFrame, years: Sequence[int] = YEARS,
    north: float = 40.0, south: float = 35.0, more: Sequence[tuple[str, float, float]] = (),
) -> DataFrame:
    """Accidents per date, state, timezone and latitude band.

    Every monthly, weekly, cohort and per-capita report below follows from this
    small table, so the fact table is read once for all of them. ``more`` names
    further columns of bands with other limits.
    """
    bands = {"band": _band(north, south), **{name: _band(n, s) for name, n, s in more}}
    days = in_years(incidents, "Start_Time", years, year_partition(incidents)).select(
        F.to_date("Start_Time").alias("date"), "State", "Timezone", *[b.alias(n) for n, b in bands.items()]
    )
    return count_by(days, ["date", "State", "Timezone", *bands], out="n")


def month_count(rollup: DataFrame) -> DataFrame:
    months = rollup.select(F.month("date").alias("Month"), "n")
    return count_by(months, ["Month"], weight="n").orderBy("Month")


def weekday_count(rollup: DataFrame) -> DataFrame:
    days = rollup.select(F.dayofweek("date").alias("day_of_Week"), "n")
    return count_by(days, ["day_of_Week"], weight="n").orderBy("day_of_Week")


def clock_rollup(incidents: DataFrame, ts: str = "Start_Time") -> DataFrame:
    """Accidents per year and hour of the day, over all years; ``ts`` may still be text."""
    times = incidents.select(ts)
    if isinstance(times.schema[0].dataType, StringType):
        times = parse_timestamp(times, ts)
    return count_by(times.select(F.year(ts).alias("Year"), F.hour(ts).alias("hour")), ["Year", "hour"], out="n")


def hour_count(incidents: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """By hour of the day, over all years; ``rollup`` may hold ``clock_rollup`` already."""
    rows = clock_rollup(incidents) if rollup is None else rollup
    return count_by(rows, ["hour"], weight="n").orderBy("hour")


def north_south(rollup: DataFrame, timezone: str = EASTERN) -> DataFrame:
    """Northern and southern accidents of one timezone, side by side per month."""
    months = rollup.filter(F.col("Timezone") == F.lit(timezone)).select(
        F.month("date").alias("month"), "band", "n"
    )
    bands = {"count_north": F.col("band") == "north", "count_south": F.col("band") == "south"}
    return cohort_compare(months, "month", bands, weight="n").orderBy("month")


def band_months(rollup: DataFrame, band: str, timezone: str = EASTERN) -> DataFrame:
    """Months of one latitude band alone."""
    rows = rollup.filter((F.col("band") == F.lit(band)) & (F.col("Timezone") == F.lit(timezone)))
    return count_by(rows.select(F.month("date").alias("Month"), "n"), ["Month"], weight="n").orderBy("Month")


def city_days(incidents: DataFrame, years: Sequence[int] = YEARS) -> DataFrame:
    """Date and city of the accidents in the given years."""
    return in_years(incidents, "Start_Time", years, year_partition(incidents)).select(
        F.to_date("Start_Time").alias("date"), F.col("City").alias("city")
    )


def city_day_rollup(days: DataFrame) -> DataFrame:
    return count_by(days, ["date", "city"], out="n")


def most_day_city(
    days: DataFrame, cities: int = 10, k: int = 12, weight: str | None = None
) -> DataFrame:
    """The worst days of the cities with most accidents, from rows or their roll-up."""
    return top_group_peaks(days, "city", "date", cities, k, weight)


def most_day_city_weather(incidents: DataFrame, peaks: DataFrame) -> DataFrame:
    """One row per accident on those days, with its weather, from the table itself.

    ``peaks`` should be staged; of a table stored by year only the folders near its days are opened.
    """
    partition = year_partition(incidents)
    rows = incidents.select(
        F.to_date("Start_Time").alias("date"), F.col("City").alias("city"), "Weather_Condition",
        *([partition] if partition else []),
    )
    attached = attach_attribute(peaks, rows, ["date", "city"], ["Weather_Condition"], "date", partition)
    return attached.select(
        F.col("date").alias("Date"), F.col("city").alias("City"), "Weather_Condition",
        F.col("count").alias("Count"),
    )


def day_weather(peak_weather: DataFrame, date: str, city: str) -> DataFrame:
    """Weather counts of one of those days."""
    rows = peak_weather.filter((F.col("Date") == F.lit(date).cast("date")) & (F.col("City") == F.lit(city)))
    return count_by(rows, ["Weather_Condition"]).orderBy(F.desc("count"), "Weather_Condition")


def red_blue(rollup: DataFrame, population: DataFrame, election: DataFrame) -> DataFrame:
    """Accidents per head of the states that voted either colour."""
    rate = two_level_rate(rollup, "State", population, election, "state", "color", "pop", weight="n")
    return rate.select(
        "color",
        F.col("total_pop").alias("sum(pop)"),
        F.col("total_count").alias("sum(count)"),
        F.col("rate").alias("avg_acc"),
    )


def street_rollup(incidents: DataFrame, years: Sequence[int] = YEARS) -> DataFrame:
    rows = in_years(incidents, "Start_Time", years, year_partition(incidents))
    roads = rows.filter(F.col("Street").isNotNull()).select(F.col("Street").alias("street"))
    return count_by(roads, ["street"], out="n")


def dangerous_roads(
    incidents: DataFrame, years: Sequence[int] = YEARS, k: int = 10, rollup: DataFrame | None = None
) -> DataFrame:
    """``rollup`` may hold ``street_rollup`` already."""
    rows = street_rollup(incidents, years) if rollup is None else rollup
    return top_k(count_by(rows, ["street"], weight="n"), "count", k, ["street"])


def year_count(
    incidents: DataFrame, ts: str = "Start_Time", rollup: DataFrame | None = None
) -> DataFrame:
    """Accidents per year; ``rollup`` may hold ``clock_rollup`` already."""
    rows = clock_rollup(incidents, ts) if rollup is None else rollup
    return count_by(rows, ["Year"], out="Counts", weight="n").orderBy("Year")


def time_reports(
    incidents: DataFrame,
    population: DataFrame,
    election: DataFrame,
    years: Sequence[int] = YEARS,
    drill_down: tuple[str, str] = ("2019-12-23", "Los Angeles"),
    bands: Sequence[tuple[float, float]] = ((40.0, 35.0), (37.0, 30.0)),
    stage=lambda df, label: df,
    kept: YearlyRollups | None = None,
) -> dict[str, DataFrame]:
    """All reports on time. ``stage`` may write the shared roll-ups down first;
    the fact table is then read four times, whatever the number of reports, and
    once more near the peak days. With ``kept`` roll-ups only changed years are read."""
    (north, south), second = bands
    rollup = partial(rolled_up, incidents, stage, kept)
    wide = rollup(
        lambda rows: calendar_rollup(rows, years, north, south, [("second", *second)]), "calendar", (list(years), bands)
    )
    narrow = wide.drop("band").withColumnRenamed("second", "band")
    clock = rollup(clock_rollup, "clock")
    days = rollup(lambda rows: city_day_rollup(city_days(rows, years)), "city_days", list(years))
    streets = rollup(lambda rows: street_rollup(rows, years), "streets", list(years))
    peaks = stage(most_day_city(days, weight="n"), "peaks")
    peak_weather = stage(most_day_city_weather(incidents, peaks), "peak_weather")
    return {
        "mostMonth": month_count(wide),
        "weekday": weekday_count(wide),
        "mostHour": hour_count(incidents, clock),
        "north_south": north_south(wide),
        "northCount": band_months(narrow, "north"),
        "southCount": band_months(narrow, "south"),
        "most_day_city": peaks.orderBy(F.desc("count"), "date", "city"),
        "most_day_city_weather": peak_weather,
        "la_1223_weather": day_weather(peak_weather, *drill_down),
        "red_blue": red_blue(wide, population, election),
        "mostDangeRoad": dangerous_roads(incidents, years, rollup=streets),
        "yearCount": year_count(incidents, rollup=clock),
    }
