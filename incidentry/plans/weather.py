"""The weather at the time of the accident."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import MISSING_DEFAULTS, WEATHER_BINS, WEATHER_BINS_WITH_OTHER, WEATHER_MEASURES, WIND_GROUPS
from ..functions.binning import regex_bin, value_map
from ..operators.aggregate import count_by
from ..operators.cleaning import drop_sentinels, not_year
from ..operators.distribution import density_curve, distribution
from ..operators.profile import histogram, pivot_counts, share


def weather_rows(incidents: DataFrame, other_than: int = 2020) -> DataFrame:
    """Severity, five measures, sky and wind of the rows that have them all."""
    columns = [*WEATHER_MEASURES, "Weather_Condition", "Wind_Direction"]
    other_years = not_year(incidents, "Start_Time", other_than)
    rows = other_years.select(
        (F.col("Severity") - F.lit(1)).alias("Severity"), *columns
    )
    return drop_sentinels(rows, {c: MISSING_DEFAULTS[c] for c in columns})


def weather_density(rows: DataFrame) -> DataFrame:
    """One row per accident: large, keep it partitioned. Charts at scale take
    ``density_summary`` and ``density_curves`` instead."""
    return rows.select("Severity", *WEATHER_MEASURES)


def density_summary(rows: DataFrame) -> DataFrame:
    return distribution(rows, "Severity", WEATHER_MEASURES)


def density_curves(rows: DataFrame) -> DataFrame:
    """The outlines of the violins."""
    return density_curve(rows, "Severity", WEATHER_MEASURES)


def density_outline(rows: DataFrame, measure: str, lo: float, width: float) -> DataFrame:
    return histogram(rows, ["Severity"], measure, lo, width)


def sky_counts(rows: DataFrame, bins=WEATHER_BINS, default: str | None = None) -> DataFrame:
    """Accidents per weather class and severity; a text in no class keeps its
    name, or counts as ``default``."""
    # Count the raw texts first: a pattern then runs once per text, not per row.
    raw = count_by(rows, ["Weather_Condition", "Severity"], out="n")
    binned = regex_bin(raw, "Weather_Condition", bins, default=default)
    return count_by(binned, ["Weather_Condition", "Severity"], out="Counts", weight="n")


def wind_counts(rows: DataFrame, groups=WIND_GROUPS) -> DataFrame:
    raw = count_by(rows, ["Wind_Direction", "Severity"], out="n")
    grouped = value_map(raw, "Wind_Direction", groups, ignore_case=True)
    return count_by(grouped, ["Wind_Direction", "Severity"], out="Counts", weight="n")


def severity_mix(counts: DataFrame, category: str) -> DataFrame:
    """The part of each severity within a weather class."""
    return share(counts, "Counts", [category])


_PIES = {1: "Severity1", 2: "Severity2", 3: "Severity3"}


def severity_pies(counts: DataFrame, category: str) -> DataFrame:
    """One row per weather class with a column per severity, as the pies are drawn."""
    return pivot_counts(counts, [category], "Severity", _PIES, weight="Counts")


def weather_reports(
    incidents: DataFrame, other_than: int = 2020, stage=lambda df, label: df
) -> dict[str, DataFrame]:
    """All reports on weather."""
    rows = stage(weather_rows(incidents, other_than), "weather")
    sky, wind = sky_counts(rows), wind_counts(rows)
    return {
        "WeatherDensity": weather_density(rows),
        "WeatherDensitySummary": density_summary(rows),
        "WeatherDensityCurves": density_curves(rows),
        "WeatherCondition": sky,
        "WeatherConditionOther": sky_counts(rows, WEATHER_BINS_WITH_OTHER, "Other"),
        "WeatherWind": wind,
        "WeatherConditionPies": severity_pies(sky, "Weather_Condition"),
        "WeatherWindPies": severity_pies(wind, "Wind_Direction"),
        "WeatherConditionMix": severity_mix(sky, "Weather_Condition"),
        "WeatherWindMix": severity_mix(wind, "Wind_Direction"),
    }
