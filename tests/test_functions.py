import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from incidentry import (
    any_flag,
    baseline,
    calendar_parts,
    constant,
    flags_to_int,
    in_years,
    not_year,
    parse_timestamp,
    ratio,
    regex_bin,
    scaled,
    value_map,
    web_mercator,
)
from incidentry.contract import (
    COLUMNS,
    INCIDENT_SCHEMA,
    MISSING_DEFAULTS,
    WEATHER_BINS,
    WEATHER_BINS_WITH_OTHER,
    WIND_GROUPS,
)


def stamps(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return df.select("id", F.col("text").cast("timestamp").alias("ts"))


def test_contract():
    assert len(COLUMNS) == len(set(COLUMNS)) == len(INCIDENT_SCHEMA) == 47
    assert set(MISSING_DEFAULTS) <= set(COLUMNS)


def test_calendar_parts_of_a_sunday_a_monday_and_new_years_eve(spark):
    df = calendar_parts(
        stamps(spark, "2019-12-22 05:00:00", "2019-12-23 00:00:00", "2019-12-31 23:59:59", None), "ts"
    )
    got = df.orderBy("id").select(
        "date", "year", "month", "day", "hour", "weekday_sunday1", "weekday_monday1"
    ).collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2019, 12, 22), 2019, 12, 22, 5, 1, 7),
        (dt.date(2019, 12, 23), 2019, 12, 23, 0, 2, 1),
        (dt.date(2019, 12, 31), 2019, 12, 31, 23, 3, 2),
        (None,) * 7,
    ]


def test_year_filters_keep_the_boundaries_and_drop_nulls(spark):
    df = stamps(
        spark, "2016-12-31 23:59:59", "2017-01-01 00:00:00", "2018-06-01 00:00:00",
        "2019-12-31 23:59:59.999", "2020-01-01 00:00:00", None,
    )
    ids = lambda d: [r["id"] for r in d.orderBy("id").collect()]
    assert ids(in_years(df, "ts", [2019, 2017, 2018])) == [1, 2, 3]
    assert ids(in_years(df, "ts", [2016, 2018])) == [0, 2]
    assert ids(in_years(df, "ts", [])) == []
    assert ids(not_year(df, "ts", 2020)) == [0, 1, 2, 3]
    shifted = baseline(df.withColumn("severity", F.lit(3)), "ts", "severity", 2020)
    assert rows(shifted.select("id", "severity")) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_year_filter_refuses_text(spark):
    with pytest.raises(TypeError, match="parse it"):
        not_year(spark.createDataFrame([("2020",)], "ts string"), "ts", 2020)


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    stamps(spark, "2019-01-01 00:00:00").write.parquet(path)
    text = plan(in_years(spark.read.parquet(path), "ts", [2018, 2019]))
    assert "GreaterThanOrEqual(ts,2018-01-01" in text


def test_unreadable_timestamps_become_null(spark):
    df = spark.createDataFrame([("2019-12-23 01:02:03",), ("soon",), (None,)], "t string")
    got = parse_timestamp(df, "t").collect()
    assert [r["t"] for r in got] == [dt.datetime(2019, 12, 23, 1, 2, 3), None, None]
    pattern = parse_timestamp(spark.createDataFrame([("23/12/2019",)], "t string"), "t", fmt="dd/MM/yyyy")
    assert pattern.first()["t"] == dt.datetime(2019, 12, 23)


SKIES = [
    "Fog", "Partly Cloudy", "Thunderstorm", "T-Storm", "Blowing Sand", "Sand / Dust Whirlwinds",
    "Ice Pellets", "light rain", None,
]


def test_weather_bins_take_the_first_match(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SKIES)], "id int, sky string")
    kept = [r["sky"] for r in regex_bin(df, "sky", WEATHER_BINS).orderBy("id").collect()]
    assert kept == [
        "Fog", "Clear & Cloudy", "Rain", "Storm", "Sand & Dust", "Sand & Dust", "Snow", "light rain", None,
    ]
    other = regex_bin(df, "sky", WEATHER_BINS_WITH_OTHER, "Other").orderBy("id").collect()
    assert [r["sky"] for r in other] == [
        "Fog", "Cloudy", "Rain", "Storm", "Sand", "Sand", "Snow", "Other", "Other",
    ]


def test_no_rules_change_nothing(spark):
    df = spark.createDataFrame([("a",)], "c string")
    assert rows(regex_bin(df, "c", [])) == [("a",)]


def test_wind_groups(spark):
    codes = [c for group in WIND_GROUPS.values() for c in group]
    assert len(codes) == 18
    df = spark.createDataFrame(
        [(c,) for c in [*codes, "Calm", "Wind_DirectionEmpty", None]], "wind string"
    )
    mapped = value_map(df, "wind", WIND_GROUPS, out="group", ignore_case=True)
    got = {r["wind"]: r["group"] for r in mapped.collect()}
    assert all(got[c] == label for label, group in WIND_GROUPS.items() for c in group)
    assert got["Calm"] == "Calm"
    assert got["Wind_DirectionEmpty"] == "Wind_DirectionEmpty" and got[None] is None
    strict = {r["wind"]: r["g"] for r in value_map(df, "wind", WIND_GROUPS, "?", "g").collect()}
    assert strict["N"] == "North" and strict["Wind_DirectionEmpty"] == "?" and strict[None] == "?"


def test_any_flag_counts_null_as_false(spark):
    cases = [(False, False), (True, False), (None, True), (None, False), (None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "id int, a boolean, b boolean")
    got = any_flag(df, ["a", "b"], "any").orderBy("id").collect()
    assert [r["any"] for r in got] == [False, True, True, False, False]
    assert rows(flags_to_int(df, ["a", "b"]).filter("id < 3")) == [(0, 0, 0), (1, 1, 0), (2, None, 1)]


def test_web_mercator(spark):
    points = [(0.0, 0.0), (10.0, 60.0), (-120.0, -45.0)]
    df = web_mercator(spark.createDataFrame(points, "lon double, lat double"), "lon", "lat")
    for r in df.collect():
        x = 6378137.0 * math.radians(r["lon"])
        y = 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(r["lat"]) / 2))
        assert r["merc_x"] == pytest.approx(x, abs=1e-6)
        assert r["merc_y"] == pytest.approx(y, abs=1e-6)


def test_small_column_helpers(spark):
    df = spark.createDataFrame([(1.5, 3), (2.0, 0)], "a double, b int")
    got = constant(scaled(df, "a", 4.0, "a4"), "c", "x").withColumn("r", ratio("a", "b", 2))
    assert rows(got) == [(1.5, 3, 6.0, "x", 0.5), (2.0, 0, 8.0, "x", None)]
