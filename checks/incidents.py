"""An incident table in the 47-column contract, derived from the line items.

Spark gets it with gaps and cleans it; the SQL has the cleaned table outright.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentry.contract import INCIDENT_SCHEMA, POI_FLAGS

from incidentry.plans.clean import clean_incidents, write_by_year
from incidentry.sources.workspace import fresh_path

from .common import table

SKIES = [
    "Fog", "Partly Cloudy", "Thunderstorm", "T-Storm", "Blowing Sand", "Ice Pellets", "Light Rain",
    "Fair", "Widespread Dust", "Snow and Sleet", "N/A Precipitation", "Squalls", "Smoke", "light rain",
]
WINDS = [
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
    "CALM", "Calm", "VAR", "Variable",
]
ZONES = ["US/Eastern", "US/Central", "US/Mountain", "US/Pacific"]

# Condition of each flag, the same text in both SQL dialects.
FLAG_RULES = {
    "Amenity": "l_quantity = 50",
    "Bump": "l_tax = 0.08 AND l_discount = 0.1",
    "Crossing": "l_discount = 0.05",
    "Give_Way": "l_quantity = 7",
    "Junction": "l_tax = 0.03",
    "No_Exit": "l_quantity = 13",
    "Railway": "l_partkey % 31 = 0",
    "Roundabout": "FALSE",
    "Station": "l_partkey % 29 = 0",
    "Stop": "l_suppkey % 23 = 0",
    "Traffic_Calming": "l_quantity = 21 AND l_tax = 0",
    "Traffic_Signal": "l_linestatus = 'O' AND l_discount > 0.07",
    "Turning_Loop": "FALSE",
}


def _pick(values: list[str], position) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns with gaps; columns no report reads are all null."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    made = {
        "ID": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "Severity": (F.lit(1) + (F.col("l_linenumber") - 1) % 4).cast("int"),
        "Start_Time": F.col("l_shipdate") + F.make_dt_interval(hours=(part % 24).cast("int")),
        "Start_Lat": F.lit(24.0) + F.col("l_quantity") / 2,
        "Start_Lng": F.lit(-125.0) + part % 58,
        "Description": F.concat(F.lit("Slow \\ near "), part.cast("string")),
        "Street": F.concat(F.lit("Street "), part.cast("string")),
        "Side": F.when(F.col("l_linestatus") == "O", "L").otherwise("R"),
        "City": F.when(supp % 50 != 0, F.concat(F.lit("City "), supp.cast("string"))),
        "State": F.concat(F.lit("S"), (supp % 25).cast("string")),
        "Timezone": _pick(ZONES, part % 4),
        "Temperature(F)": F.when(part % 17 != 0, F.col("l_quantity") * 2),
        "Humidity(%)": F.when(part % 37 != 0, F.col("l_discount") * 1000),
        "Pressure(in)": F.lit(28.0) + F.col("l_tax") * 25,
        "Visibility(mi)": F.when(part % 19 != 0, F.col("l_quantity") / 5),
        "Wind_Speed(mph)": F.col("l_linenumber") * 3.0,
        "Wind_Direction": F.when(part % 41 != 0, _pick(WINDS, supp % len(WINDS))),
        "Weather_Condition": F.when(part % 43 != 0, _pick(SKIES, part % len(SKIES))),
        **{flag: F.expr(rule) for flag, rule in FLAG_RULES.items()},
    }
    lines = table(spark, sf_dir, "lineitem")
    columns = []
    for field in INCIDENT_SCHEMA:
        column = made.get(field.name, F.lit(None).cast(field.dataType))
        columns.append(column.alias(field.name))
    return lines.select(*columns)


_PREPARED: dict[tuple[str, str], str] = {}


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean the table, store it by year as the cleaning job does, and read it back."""
    path = fresh_path(spark, "incidents")
    write_by_year(clean_incidents(raw_incidents(spark, sf_dir)), path)
    _PREPARED[spark.sparkContext.applicationId, sf_dir] = path
    return spark.read.parquet(path)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table, written on first use in a session; reports read it as
    they would read the output of the cleaning job."""
    path = _PREPARED.get((spark.sparkContext.applicationId, sf_dir))
    return spark.read.parquet(path) if path else store(spark, sf_dir)


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation, as the population of a state."""
    state = F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))
    customers = table(spark, sf_dir, "customer").select(state.alias("state"))
    return customers.groupBy("state").agg(F.count("*").alias("pop"))


def election(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A colour for each nation."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("state"),
        F.when(F.col("n_regionkey") % 2 == 0, "red").otherwise("blue").alias("color"),
    )


def _sql_list(values: list[str], position: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{position} + 1]"


_SQL_FLAGS = ",\n".join(f"{FLAG_RULES[f]} AS {f}" for f in POI_FLAGS)

SQL_INCIDENTS = f"""
    incidents AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ID,
            CAST((l_linenumber - 1) % 4 AS BIGINT) AS Severity,
            l_shipdate + to_hours(CAST(l_partkey % 24 AS INT)) AS Start_Time,
            24.0::DOUBLE + l_quantity / 2 AS Start_Lat,
            -125.0::DOUBLE + l_partkey % 58 AS Start_Lng,
            'Street ' || l_partkey AS Street,
            CASE WHEN l_linestatus = 'O' THEN 'L' ELSE 'R' END AS Side,
            CASE WHEN l_suppkey % 50 <> 0 THEN 'City ' || l_suppkey ELSE 'CityEmpty' END AS City,
            'S' || (l_suppkey % 25) AS State,
            {_sql_list(ZONES, 'l_partkey % 4')} AS Timezone,
            CASE WHEN l_partkey % 17 <> 0 THEN l_quantity * 2 ELSE -999.0 END AS temperature,
            CASE WHEN l_partkey % 37 <> 0 THEN l_discount * 1000 ELSE -999.0 END AS humidity,
            28.0::DOUBLE + l_tax * 25 AS pressure,
            CASE WHEN l_partkey % 19 <> 0 THEN l_quantity / 5 ELSE -999.0 END AS visibility,
            l_linenumber * 3.0::DOUBLE AS wind_speed,
            CASE WHEN l_partkey % 41 <> 0 THEN {_sql_list(WINDS, f'l_suppkey % {len(WINDS)}')}
                 ELSE 'Wind_DirectionEmpty' END AS wind_direction,
            CASE WHEN l_partkey % 43 <> 0 THEN {_sql_list(SKIES, f'l_partkey % {len(SKIES)}')}
                 ELSE 'Weather_ConditionEmpty' END AS weather_condition,
            {_SQL_FLAGS}
        FROM lineitem)"""

SQL_DIMENSIONS = """
    population AS (
        SELECT 'S' || c_nationkey AS state, count(*) AS pop FROM customer GROUP BY 1),
    election AS (
        SELECT 'S' || n_nationkey AS state,
               CASE WHEN n_regionkey % 2 = 0 THEN 'red' ELSE 'blue' END AS color
        FROM nation)"""
