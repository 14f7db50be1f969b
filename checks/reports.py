"""Every named report, run over the incident table derived from the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from incidentry.contract import (
    POI_FLAGS,
    WEATHER_BINS,
    WEATHER_BINS_WITH_OTHER,
    WEATHER_MEASURES,
    WIND_GROUPS,
)
from incidentry.operators.aggregate import value_bounds
from incidentry.operators.profile import flags_long, geo_grid, series, share, tile_pyramid
from incidentry.plans import address, clean, roadside, time, weather
from incidentry.sources.workspace import stage

from .common import as_long, rounded, sql_round
from .profiles import sql_density
from .incidents import (
    SQL_DIMENSIONS,
    SQL_INCIDENTS,
    election,
    incidents,
    population,
    raw_incidents,
)

YEARS = (1996, 1997, 1998)
CUTOFF = 2000


# --- cleaning ---------------------------------------------------------------

def missing_before(spark, sf):
    return clean.cleaning_reports(raw_incidents(spark, sf), incidents(spark, sf))["missingBefore"]


def missing_after(spark, sf):
    return clean.cleaning_reports(raw_incidents(spark, sf), incidents(spark, sf))["missingAfter"]


# --- time -------------------------------------------------------------------


def _calendar(spark, sf, north=40.0, south=35.0):
    return time.calendar_rollup(incidents(spark, sf), YEARS, north, south)


def month_count(spark, sf):
    return as_long(time.month_count(_calendar(spark, sf)), "Month")


def weekday_count(spark, sf):
    return as_long(time.weekday_count(_calendar(spark, sf)), "day_of_Week")


def hour_count(spark, sf):
    return as_long(time.hour_count(incidents(spark, sf)), "hour")


def north_south(spark, sf):
    return as_long(time.north_south(_calendar(spark, sf)), "month")


def north_count(spark, sf):
    return as_long(time.band_months(_calendar(spark, sf, 37.0, 30.0), "north"), "Month")


def south_count(spark, sf):
    return as_long(time.band_months(_calendar(spark, sf, 37.0, 30.0), "south"), "Month")


def most_day_city(spark, sf):
    peaks = time.most_day_city(time.city_days(incidents(spark, sf), YEARS))
    return peaks.withColumn("date", F.col("date").cast("string"))


def most_day_city_weather(spark, sf):
    peaks = stage(time.most_day_city(time.city_days(incidents(spark, sf), YEARS)), "peaks")
    rows = time.most_day_city_weather(incidents(spark, sf), peaks)
    return rows.withColumn("Date", F.col("Date").cast("string"))


def day_weather(spark, sf):
    """Weather of the very worst day; its date and city are read first."""
    peaks = stage(time.most_day_city(time.city_days(incidents(spark, sf), YEARS)), "peaks")
    worst = peaks.orderBy(F.desc("count"), "date", "city").first()
    return time.day_weather(time.most_day_city_weather(incidents(spark, sf), peaks), str(worst["date"]), worst["city"])


def red_blue(spark, sf):
    return time.red_blue(_calendar(spark, sf), population(spark, sf), election(spark, sf))


def dangerous_roads(spark, sf):
    return time.dangerous_roads(incidents(spark, sf), YEARS)


def year_count(spark, sf):
    return as_long(time.year_count(incidents(spark, sf)), "Year")


# --- address ----------------------------------------------------------------


def _places(spark, sf):
    return address.address_rollup(incidents(spark, sf), CUTOFF)


def side_and_severity(spark, sf):
    return as_long(address.side_and_severity(_places(spark, sf)), "Severity")


def left_side(spark, sf):
    counts = address.side_and_severity(_places(spark, sf))
    return as_long(series(counts, "Side", "L", ["Severity"]), "Severity")


def side_bars(spark, sf):
    reports = address.address_reports(incidents(spark, sf), population(spark, sf), CUTOFF)
    return as_long(reports["LeftSide"].unionByName(reports["RightSide"]), "Severity")


def city_count(spark, sf):
    return address.city_count(_places(spark, sf))


def city_count_bounds(spark, sf):
    return rounded(value_bounds(address.city_count(_places(spark, sf)), "Count"), 6, "lower_bound", "upper_bound")


def state_count(spark, sf):
    return rounded(address.state_count(_places(spark, sf), population(spark, sf)), 6, "AccidentsPerPerson")


def city_average(spark, sf):
    return address.city_average(_places(spark, sf))


def timezone_summary(spark, sf):
    return address.timezone_summary(_places(spark, sf))


def timezone_share(spark, sf):
    return share(address.timezone_summary(_places(spark, sf)), "Count", digits=6).select("Timezone", "share")


# --- roadside ---------------------------------------------------------------


def _roadside(spark, sf):
    return roadside.roadside_rollup(incidents(spark, sf), CUTOFF)


def average_visibility(spark, sf):
    means = roadside.average_visibility(_roadside(spark, sf))
    return rounded(as_long(means, "Severity"), 6, "avg(Visibility(mi))")


def poi_presence(spark, sf):
    return roadside.poi_presence(_roadside(spark, sf))


def severity_with_poi(spark, sf):
    return as_long(roadside.severity_with_poi(_roadside(spark, sf)), "Severity")


def severity_without_poi(spark, sf):
    return as_long(roadside.severity_without_poi(_roadside(spark, sf)), "Severity")


def poi_totals(spark, sf):
    return roadside.poi_totals(_roadside(spark, sf))


def poi_totals_by_severity(spark, sf):
    return as_long(roadside.poi_totals_by_severity(_roadside(spark, sf)), "Severity")


def poi_long(spark, sf):
    return as_long(roadside.poi_long(_roadside(spark, sf)), "Severity")


def poi_totals_long(spark, sf):
    totals = roadside.poi_totals_by_severity(_roadside(spark, sf))
    return as_long(flags_long(totals, [f"sum({f})" for f in POI_FLAGS], ["Severity"], "poi"), "Severity")


# --- weather ----------------------------------------------------------------


def _weather(spark, sf):
    return weather.weather_rows(incidents(spark, sf), CUTOFF)


def weather_density(spark, sf):
    return rounded(as_long(weather.weather_density(_weather(spark, sf)), "Severity"), 6, *WEATHER_MEASURES)


def weather_summary(spark, sf):
    summary = weather.density_summary(_weather(spark, sf))
    return rounded(as_long(summary, "Severity"), 6, "min", "p25", "p50", "p75", "max", "mean", "stddev")


def weather_curves(spark, sf):
    """The violins' outlines; the density is given per bandwidth."""
    curves = weather.density_curves(_weather(spark, sf)).withColumn("density", F.col("density") * F.col("bandwidth"))
    curves = as_long(curves.withColumnRenamed("Severity", "severity"), "severity", "point")
    return rounded(rounded(curves, 6, "value", "bandwidth"), 9, "density")


def weather_outline(spark, sf):
    return as_long(weather.density_outline(_weather(spark, sf), "Temperature(F)", 0.0, 5.0), "Severity")


def sky_counts(spark, sf):
    return as_long(weather.sky_counts(_weather(spark, sf)), "Severity")


def sky_counts_with_other(spark, sf):
    return as_long(weather.sky_counts(_weather(spark, sf), WEATHER_BINS_WITH_OTHER, "Other"), "Severity")


def wind_counts(spark, sf):
    return as_long(weather.wind_counts(_weather(spark, sf)), "Severity")


def sky_mix(spark, sf):
    mix = weather.severity_mix(weather.sky_counts(_weather(spark, sf)), "Weather_Condition")
    return rounded(as_long(mix, "Severity"), 6, "share")


def wind_mix(spark, sf):
    mix = weather.severity_mix(weather.wind_counts(_weather(spark, sf)), "Wind_Direction")
    return rounded(as_long(mix, "Severity"), 6, "share")


def sky_pies(spark, sf):
    return weather.severity_pies(weather.sky_counts(_weather(spark, sf)), "Weather_Condition")


# --- map --------------------------------------------------------------------


def incident_tiles(spark, sf):
    tiles = tile_pyramid(incidents(spark, sf), "Start_Lat", "Start_Lng", ["Severity"], 4, 12)
    return as_long(tiles.withColumn("Severity", F.col("Severity") - 1), "Severity", "zoom", "x", "y")


def incident_map(spark, sf):
    cells = geo_grid(incidents(spark, sf), "Start_Lat", "Start_Lng", 2.0, ["Severity"])
    return as_long(cells.withColumn("Severity", F.col("Severity") - 1), "Severity")


QUERIES = {
    "report_missing_before": missing_before,
    "report_missing_after": missing_after,
    "report_month_count": month_count,
    "report_weekday": weekday_count,
    "report_most_hour": hour_count,
    "report_north_south": north_south,
    "report_north_count": north_count,
    "report_south_count": south_count,
    "report_most_day_city": most_day_city,
    "report_most_day_city_weather": most_day_city_weather,
    "report_day_weather": day_weather,
    "report_red_blue": red_blue,
    "report_dangerous_roads": dangerous_roads,
    "report_year_count": year_count,
    "report_side_and_severity": side_and_severity,
    "report_left_side": left_side,
    "report_city_count": city_count,
    "report_city_count_bounds": city_count_bounds,
    "report_state_count": state_count,
    "report_city_average": city_average,
    "report_timezone": timezone_summary,
    "report_timezone_share": timezone_share,
    "report_average_visibility": average_visibility,
    "report_poi_presence": poi_presence,
    "report_severity_with_poi": severity_with_poi,
    "report_severity_without_poi": severity_without_poi,
    "report_poi_totals": poi_totals,
    "report_poi_totals_by_severity": poi_totals_by_severity,
    "report_poi_totals_long": poi_totals_long,
    "report_weather_density": weather_density,
    "report_weather_summary": weather_summary,
    "report_weather_curves": weather_curves,
    "report_weather_outline": weather_outline,
    "report_sky_counts": sky_counts,
    "report_sky_counts_with_other": sky_counts_with_other,
    "report_wind_counts": wind_counts,
    "report_sky_mix": sky_mix,
    "report_wind_mix": wind_mix,
    "report_incident_map": incident_map,
    "report_incident_tiles": incident_tiles,
    "report_sky_pies": sky_pies,
    "report_poi_long": poi_long,
    "report_side_bars": side_bars,
}

# --- the same in SQL --------------------------------------------------------

_BASE = f"WITH {SQL_INCIDENTS}, {SQL_DIMENSIONS}"
_IN_YEARS = "year(Start_Time) IN (1996, 1997, 1998)"
_BEFORE = f"year(Start_Time) < {CUTOFF}"

_DAYS = f"""
    days AS (
        SELECT strftime(Start_Time, '%Y-%m-%d') AS date, City AS city, weather_condition
        FROM incidents WHERE {_IN_YEARS}),
    daily AS (SELECT date, city, count(*) AS count FROM days GROUP BY 1, 2),
    leaders AS (SELECT city FROM daily GROUP BY 1 ORDER BY sum(count) DESC, city LIMIT 10),
    peaks AS (
        SELECT daily.* FROM daily JOIN leaders USING (city) ORDER BY count DESC, date, city LIMIT 12),
    attached AS (
        SELECT p.date AS Date, p.city AS City, d.weather_condition AS Weather_Condition, p.count AS Count
        FROM days d JOIN peaks p ON d.date = p.date AND d.city = p.city)"""


def _by_month(month: str, condition: str) -> str:
    return f"""{_BASE} SELECT month(Start_Time) AS {month}, count(*) AS count FROM incidents
        WHERE {_IN_YEARS} AND {condition} GROUP BY 1"""


def _largest(key: str, digits: int) -> str:
    return f"""largest AS (
        SELECT {key}, count(*) AS Count, {sql_round('avg(Severity)', digits)} AS AvgSeverity
        FROM incidents WHERE {_BEFORE} GROUP BY 1 ORDER BY Count DESC, {key} LIMIT 10)"""


_ANY_POI = " OR ".join(POI_FLAGS)
_POI_SUMS = ", ".join(f'CAST(sum(CAST({f} AS INT)) AS BIGINT) AS "sum({f})"' for f in POI_FLAGS)

_SQL_MEASURES = dict(zip(WEATHER_MEASURES, ["temperature", "humidity", "pressure", "visibility", "wind_speed"]))
_WEATHER = f"""
    clear AS (
        SELECT * FROM incidents
        WHERE year(Start_Time) <> {CUTOFF}
          AND {' AND '.join(f'{m} <> -999.0' for m in _SQL_MEASURES.values())}
          AND wind_direction <> 'Wind_DirectionEmpty'
          AND weather_condition <> 'Weather_ConditionEmpty')"""


def _sky(bins, otherwise: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(weather_condition, '{p}') THEN '{label}'" for p, label in bins)
    return f"""{_BASE}, {_WEATHER},
        mix AS (
            SELECT CASE {whens} ELSE {otherwise} END AS Weather_Condition, Severity, count(*) AS Counts
            FROM clear GROUP BY 1, 2)"""


def _wind() -> str:
    whens = " ".join(
        f"WHEN upper(wind_direction) IN ({', '.join(repr(v) for v in members)}) THEN '{label}'"
        for label, members in WIND_GROUPS.items()
    )
    return f"""{_BASE}, {_WEATHER},
        mix AS (
            SELECT CASE {whens} ELSE wind_direction END AS Wind_Direction, Severity, count(*) AS Counts
            FROM clear GROUP BY 1, 2)"""


def _mix(category: str) -> str:
    part = sql_round(f"CAST(Counts AS DOUBLE) / sum(Counts) OVER (PARTITION BY {category})", 6)
    return f" SELECT {category}, Severity, Counts, {part} AS share FROM mix"


def _summary() -> str:
    parts = {
        "min": "min({0})", "p25": "quantile_cont({0}, 0.25)", "p50": "quantile_cont({0}, 0.5)",
        "p75": "quantile_cont({0}, 0.75)", "max": "max({0})", "mean": "avg({0})",
        "stddev": "stddev_samp({0})",
    }
    return f"{_BASE}, {_WEATHER} " + " UNION ALL ".join(
        f"SELECT Severity, '{name}' AS measure, count(*) AS n, "
        + ", ".join(f"{sql_round(e.format(c), 6)} AS {part}" for part, e in parts.items())
        + " FROM clear GROUP BY 1"
        for name, c in _SQL_MEASURES.items()
    )


# Columns that the raw table leaves empty: those with a default are filled, the others stay so.
_NEVER_FILLED = ["End_Time", "End_Lat", "End_Lng", "Distance(mi)", "County", "Country"]
_FILLED = [
    "Number", "Zipcode", "Airport_Code", "Weather_Timestamp", "Wind_Chill(F)", "Precipitation(in)",
    "Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight",
]


def _empty(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS null_count FROM lineitem HAVING count(*) > 0"
        for name in columns
    )


def _missing() -> str:
    columns = {
        "City": "City = 'CityEmpty'",
        "Temperature(F)": "temperature = -999.0",
        "Humidity(%)": "humidity = -999.0",
        "Visibility(mi)": "visibility = -999.0",
        "Wind_Direction": "wind_direction = 'Wind_DirectionEmpty'",
        "Weather_Condition": "weather_condition = 'Weather_ConditionEmpty'",
    }
    return f"{_BASE} " + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS null_count FROM incidents WHERE {c} HAVING count(*) > 0"
        for name, c in columns.items()
    )


ORACLE = {
    "report_missing_before": _missing() + " UNION ALL " + _empty(_NEVER_FILLED + _FILLED),
    "report_missing_after": _empty(_NEVER_FILLED),
    "report_month_count": _by_month("Month", "TRUE"),
    "report_weekday": f"""{_BASE} SELECT dayofweek(Start_Time) + 1 AS day_of_Week, count(*) AS count
        FROM incidents WHERE {_IN_YEARS} GROUP BY 1""",
    "report_most_hour": f"{_BASE} SELECT hour(Start_Time) AS hour, count(*) AS count FROM incidents GROUP BY 1",
    "report_north_south": f"""{_BASE},
        eastern AS (
            SELECT month(Start_Time) AS month, Start_Lat FROM incidents
            WHERE {_IN_YEARS} AND Timezone = 'US/Eastern'),
        north AS (SELECT month, count(*) AS count_north FROM eastern WHERE Start_Lat > 40 GROUP BY 1),
        south AS (SELECT month, count(*) AS count_south FROM eastern WHERE Start_Lat < 35 GROUP BY 1)
        SELECT month, count_north, count_south FROM north JOIN south USING (month)""",
    "report_north_count": _by_month("Month", "Start_Lat > 37 AND Timezone = 'US/Eastern'"),
    "report_south_count": _by_month("Month", "Start_Lat < 30 AND Timezone = 'US/Eastern'"),
    "report_most_day_city": f"{_BASE}, {_DAYS} SELECT date, city, count FROM peaks",
    "report_most_day_city_weather": f"{_BASE}, {_DAYS} SELECT * FROM attached",
    "report_day_weather": f"""{_BASE}, {_DAYS}
        SELECT Weather_Condition, count(*) AS count FROM attached
        WHERE (Date, City) = (SELECT (date, city) FROM peaks ORDER BY count DESC, date, city LIMIT 1)
        GROUP BY 1""",
    "report_red_blue": f"""{_BASE},
        heads AS (SELECT color, sum(pop) AS p FROM population JOIN election USING (state) GROUP BY 1),
        crashes AS (
            SELECT color, count(*) AS c FROM incidents JOIN election ON incidents.State = election.state
            WHERE {_IN_YEARS} GROUP BY 1)
        SELECT color, CAST(p AS BIGINT) AS "sum(pop)", c AS "sum(count)",
               {sql_round('CAST(c AS DOUBLE) / p', 6)} AS avg_acc
        FROM heads JOIN crashes USING (color)""",
    "report_dangerous_roads": f"""{_BASE} SELECT Street AS street, count(*) AS count FROM incidents
        WHERE {_IN_YEARS} GROUP BY 1 ORDER BY count DESC, street LIMIT 10""",
    "report_year_count": f"{_BASE} SELECT year(Start_Time) AS Year, count(*) AS Counts FROM incidents GROUP BY 1",
    "report_side_and_severity": f"""{_BASE} SELECT Side, Severity, count(*) AS Count FROM incidents
        WHERE {_BEFORE} GROUP BY 1, 2""",
    "report_left_side": f"""{_BASE} SELECT Side, Severity, count(*) AS Count FROM incidents
        WHERE {_BEFORE} AND Side = 'L' GROUP BY 1, 2""",
    "report_city_count": f"{_BASE}, {_largest('City', 2)} SELECT * FROM largest",
    "report_city_count_bounds": f"""{_BASE}, {_largest('City', 2)}
        SELECT {sql_round('min(Count) * 0.9', 6)} AS lower_bound,
               {sql_round('max(Count) * 1.1', 6)} AS upper_bound FROM largest""",
    "report_state_count": f"""{_BASE}, {_largest('State', 2)}
        SELECT l.State, Count, AvgSeverity, pop,
               {sql_round('CAST(Count AS DOUBLE) / pop', 6)} AS AccidentsPerPerson
        FROM largest l JOIN population p ON l.State = p.state""",
    "report_city_average": f"""{_BASE},
        per AS (
            SELECT City, count(*) AS Count, avg(Severity) AS a FROM incidents WHERE {_BEFORE}
            GROUP BY 1 HAVING count(*) > 100 ORDER BY a DESC, City LIMIT 10)
        SELECT City, Count, {sql_round('a', 3)} AS AvgSeverity FROM per""",
    "report_timezone": f"{_BASE}, {_largest('Timezone', 3)} SELECT * FROM largest",
    "report_timezone_share": f"""{_BASE}, {_largest('Timezone', 3)}
        SELECT Timezone, {sql_round('CAST(Count AS DOUBLE) / sum(Count) OVER ()', 6)} AS share FROM largest""",
    "report_average_visibility": f"""{_BASE}
        SELECT Severity, {sql_round('avg(visibility)', 6)} AS "avg(Visibility(mi))" FROM incidents
        WHERE {_BEFORE} AND visibility >= 0 GROUP BY 1""",
    "report_poi_presence": f"""{_BASE} SELECT ({_ANY_POI}) AS "has_POI", count(*) AS count FROM incidents
        WHERE {_BEFORE} GROUP BY 1""",
    "report_severity_with_poi": f"""{_BASE} SELECT Severity, count(*) AS count FROM incidents
        WHERE {_BEFORE} AND ({_ANY_POI}) GROUP BY 1""",
    "report_severity_without_poi": f"""{_BASE} SELECT Severity, count(*) AS count FROM incidents
        WHERE {_BEFORE} AND NOT ({_ANY_POI}) GROUP BY 1""",
    "report_poi_totals": f"{_BASE} SELECT {_POI_SUMS} FROM incidents WHERE {_BEFORE} AND ({_ANY_POI})",
    "report_poi_totals_by_severity": f"""{_BASE} SELECT Severity, {_POI_SUMS} FROM incidents
        WHERE {_BEFORE} AND ({_ANY_POI}) GROUP BY 1""",
    "report_poi_totals_long": f"{_BASE} " + " UNION ALL ".join(
        f"""SELECT Severity, 'sum({f})' AS poi, CAST(sum(CAST({f} AS INT)) AS BIGINT) AS count
        FROM incidents WHERE {_BEFORE} AND ({_ANY_POI}) GROUP BY 1"""
        for f in POI_FLAGS
    ),
    "report_weather_density": f"{_BASE}, {_WEATHER} SELECT Severity, " + ", ".join(
        f'{sql_round(c, 6)} AS "{name}"' for name, c in _SQL_MEASURES.items()
    ) + " FROM clear",
    "report_weather_summary": _summary(),
    "report_weather_curves": f"{_BASE}, {_WEATHER} " + " UNION ALL ".join(
        sql_density("clear", "Severity", column, name) for name, column in _SQL_MEASURES.items()
    ),
    "report_weather_outline": f"""{_BASE}, {_WEATHER}
        SELECT Severity, CAST(floor(temperature / 5.0::DOUBLE) AS BIGINT) AS bin, count(*) AS count
        FROM clear GROUP BY 1, 2""",
    "report_sky_counts": _sky(WEATHER_BINS, "weather_condition") + " SELECT * FROM mix",
    "report_sky_counts_with_other": _sky(WEATHER_BINS_WITH_OTHER, "'Other'") + " SELECT * FROM mix",
    "report_wind_counts": _wind() + " SELECT * FROM mix",
    "report_sky_mix": _sky(WEATHER_BINS, "weather_condition") + _mix("Weather_Condition"),
    "report_wind_mix": _wind() + _mix("Wind_Direction"),
    "report_incident_tiles": f"""{_BASE},
        tiles AS (
            SELECT Severity, z AS zoom, CAST(floor((Start_Lng + 180) / 360 * pow(2, z)) AS BIGINT) AS x,
                   CAST(floor((1 - asinh(tan(radians(Start_Lat))) / pi()) / 2 * pow(2, z)) AS BIGINT) AS y
            FROM incidents, unnest(range(4, 13)) AS t(z))
        SELECT Severity, zoom, x, y, count(*) AS count,
               array_to_string(list_transform(range(zoom - 1, -1, -1), lambda i: ((x >> i) & 1) + 2 * ((y >> i) & 1)), '')
               AS quadkey
        FROM tiles GROUP BY Severity, zoom, x, y""",
    "report_sky_pies": _sky(WEATHER_BINS, "weather_condition") + """
        SELECT Weather_Condition, """ + ", ".join(
            f"CAST(coalesce(sum(Counts) FILTER (Severity = {i}), 0) AS BIGINT) AS Severity{i}" for i in (1, 2, 3)
        ) + " FROM mix GROUP BY 1",
    "report_poi_long": f"{_BASE} " + " UNION ALL ".join(
        f"""SELECT Severity, '{f}' AS POI, CAST(sum(CAST({f} AS INT)) AS BIGINT) AS Count
        FROM incidents WHERE {_BEFORE} AND ({_ANY_POI}) GROUP BY 1"""
        for f in POI_FLAGS
    ),
    "report_side_bars": f"""{_BASE} SELECT Side, Severity, count(*) AS Count FROM incidents
        WHERE {_BEFORE} AND Side IN ('L', 'R') GROUP BY 1, 2""",
    "report_incident_map": f"""{_BASE}
        SELECT Severity, CAST(floor(Start_Lat / 2.0::DOUBLE) AS BIGINT) AS lat_cell,
               CAST(floor(Start_Lng / 2.0::DOUBLE) AS BIGINT) AS lon_cell, count(*) AS count
        FROM incidents GROUP BY 1, 2, 3""",
}
