"""Points of interest near the accident."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import POI_FLAGS
from ..functions.columns import any_flag, ratio, real_value
from ..operators.aggregate import count_by, flag_totals
from ..operators.cleaning import baseline
from ..operators.profile import flags_long
from ..sources.rollups import YearlyRollups
from .clean import rolled_up, year_partition

_VISIBILITY = "Visibility(mi)"


def roadside_rollup(incidents: DataFrame, before_year: int = 2020) -> DataFrame:
    """Accidents and total visibility per severity and flag combination.

    Thirteen flags and a few severities bound this table whatever the number of
    accidents, and every report below is a sum over it.
    """
    rows = baseline(
        incidents, "Start_Time", "Severity", before_year, partition=year_partition(incidents)
    )
    seen = real_value(rows, _VISIBILITY)
    clear = F.when(seen >= F.lit(0.0), seen)
    rollup = rows.groupBy("Severity", *POI_FLAGS).agg(
        F.count("*").alias("n"),
        F.sum(clear).alias("visibility"),
        F.count(clear).alias("n_visibility"),
    )
    return any_flag(rollup, POI_FLAGS, "has_POI")


def average_visibility(rollup: DataFrame) -> DataFrame:
    # A severity without a single reading is left out, not shown as empty.
    means = rollup.filter(F.col("n_visibility") > 0).groupBy("Severity").agg(
        ratio(F.sum("visibility"), F.sum("n_visibility")).alias(f"avg({_VISIBILITY})")
    )
    return means.orderBy("Severity")


def poi_presence(rollup: DataFrame) -> DataFrame:
    return count_by(rollup, ["has_POI"], weight="n")


def severity_with_poi(rollup: DataFrame) -> DataFrame:
    return count_by(rollup.filter("has_POI"), ["Severity"], weight="n").orderBy("Severity")


def severity_without_poi(rollup: DataFrame) -> DataFrame:
    return count_by(rollup.filter(~F.col("has_POI")), ["Severity"], weight="n").orderBy("Severity")


_SUM_NAMES = {flag: f"sum({flag})" for flag in POI_FLAGS}


def poi_totals(rollup: DataFrame) -> DataFrame:
    return flag_totals(rollup.filter("has_POI"), POI_FLAGS, weight="n", names=_SUM_NAMES)


def poi_totals_by_severity(rollup: DataFrame) -> DataFrame:
    near = rollup.filter("has_POI")
    return flag_totals(near, POI_FLAGS, ["Severity"], weight="n", names=_SUM_NAMES).orderBy("Severity")


def poi_long(rollup: DataFrame) -> DataFrame:
    """One row per severity and kind of place, as the grouped bars are drawn."""
    totals = poi_totals_by_severity(rollup).withColumnsRenamed({v: k for k, v in _SUM_NAMES.items()})
    return flags_long(totals, POI_FLAGS, ["Severity"], "POI", "Count")


def roadside_reports(
    incidents: DataFrame, before_year: int = 2020, stage=lambda df, label: df,
    kept: YearlyRollups | None = None,
) -> dict[str, DataFrame]:
    """All reports on points of interest."""
    rollup = rolled_up(
        incidents, stage, kept, lambda rows: roadside_rollup(rows, before_year), "roadside", before_year
    )
    return {
        "countSevLong": poi_long(rollup),
        "AvgVisi": average_visibility(rollup),
        "numPOI": poi_presence(rollup),
        "SevHasPOI": severity_with_poi(rollup),
        "SevNoPOI": severity_without_poi(rollup),
        "countPOI": poi_totals(rollup),
        "countSev": poi_totals_by_severity(rollup),
    }
