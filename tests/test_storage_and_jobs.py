import glob
import json
import os
import re
import subprocess
import sys
import types

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import all_oracles
from checks.compare import duck
from checks.incidents import election, population, raw_incidents
from conftest import plan, rows
from incidentry import (
    YearlyRollups,
    count_by,
    in_years,
    load_result,
    read_csv,
    read_table,
    replace_result,
    run_outputs,
    save_result,
    stage,
)
from incidentry.contract import INCIDENT_SCHEMA, POPULATION_SCHEMA
from incidentry.plans import clean, time
from incidentry.plans.address import address_reports
from incidentry.plans.clean import clean_incidents, write_by_year
from incidentry.plans.roadside import roadside_reports
from incidentry.plans.runner import run
from incidentry.plans.time import time_reports
from incidentry.sources.workspace import discard, stage_alone, workspace

SF = "/root/testdata/sf0.001"


def test_csv_keeps_quotes_commas_nulls_and_backslashes(spark, tmp_path):
    data = [(1, 'say "hi", twice'), (2, None), (3, '"'), (4, "back\\slash"), (5, "ünï\\")]
    df = spark.createDataFrame(data, "id int, text string")
    save_result(df, str(tmp_path), "t", "csv")
    assert rows(read_csv(spark, f"{tmp_path}/t", df.schema)) == rows(df)
    assert rows(load_result(spark, str(tmp_path), "t", "csv").select("id")) == [(str(i),) for i in range(1, 6)]


def test_csv_without_header_takes_every_line_as_data(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, text string").coalesce(1)
    save_result(df, str(tmp_path), "t", "csv")
    assert read_csv(spark, f"{tmp_path}/t", df.schema, header=False).count() == 2


def test_csv_binds_by_position(spark, tmp_path):
    save_result(spark.createDataFrame([(1, "a")], "x int, y string"), str(tmp_path), "t", "csv")
    assert rows(read_csv(spark, f"{tmp_path}/t", INCIDENT_SCHEMA.fromJson(
        {"type": "struct", "fields": [
            {"name": n, "type": t, "nullable": True, "metadata": {}}
            for n, t in (("n", "integer"), ("s", "string"))]}
    )).select("n", "s")) == [(1, "a")]


def test_result_is_replaced_and_loses_its_storage_id(spark, tmp_path):
    root = str(tmp_path)
    for value in (1, 2):
        df = spark.createDataFrame([("oid", value)], "_id string, v int")
        save_result(df, root, "r")
    assert rows(load_result(spark, root, "r")) == [(2,)]


def test_json_schema_is_inferred(spark, tmp_path):
    save_result(spark.createDataFrame([(1, "a", 0.5)], "i int, s string, d double"), str(tmp_path), "j", "json")
    df = read_table(spark, f"{tmp_path}/j", "json")
    assert dict(df.dtypes) == {"i": "bigint", "s": "string", "d": "double"}


def test_small_results_are_one_file_and_large_ones_are_not(spark, tmp_path):
    df = spark.range(0, 1000, 1, 16)
    save_result(df, str(tmp_path), "small", single_file=True)
    assert len(glob.glob(f"{tmp_path}/small/part-*")) == 1
    sizes = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(sizes)
    try:
        spark.conf.set(sizes, "64KB")
        save_result(spark.range(0, 2_000_000, 1, 16), str(tmp_path), "large", single_file=True)
    finally:
        spark.conf.set(sizes, old)
    assert len(glob.glob(f"{tmp_path}/large/part-*")) > 1


@pytest.mark.parametrize("reuse", ["stage", "persist", "none"])
def test_run_outputs(spark, tmp_path, reuse):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    outputs = {"by_k": lambda d: count_by(d, ["k"]), "by_v": lambda d: count_by(d, ["v"])}
    run_outputs(df, outputs, str(tmp_path), reuse=reuse)
    assert rows(load_result(spark, str(tmp_path), "by_k")) == [("a", 2), ("b", 1)]
    assert rows(load_result(spark, str(tmp_path), "by_v")) == [(1, 2), (2, 1)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    with pytest.raises(ValueError, match="reuse"):
        run_outputs(df, outputs, str(tmp_path), reuse="magic")


def test_stage_cuts_the_lineage(spark):
    df = stage(spark.range(5).withColumn("Distance(mi)", F.lit(1.0)), "t")
    assert df.count() == 5 and "Range" not in plan(df)


def fake_session(**settings):
    conf = types.SimpleNamespace(
        get=lambda k, d=None: settings.get(k, d), set=lambda k, v: settings.__setitem__(k, v)
    )
    return types.SimpleNamespace(conf=conf)


def test_what_is_staged_on_the_way_is_removed(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = lambda: set(glob.glob(f"{folder}/incidentry/*"))
    before = staged()

    def build():
        first = stage(spark.range(5), "first")
        second = stage(first.selectExpr("id * 2 AS id"), "second")
        discard(first)
        return second.filter("id > 2")

    out = stage_alone(build, "out")
    assert rows(out) == [(4,), (6,), (8,)]
    assert len(staged() - before) == 1  # the result alone
    discard(out)
    lazy = stage_alone(lambda: spark.range(3), "lazy")
    assert lazy.count() == 3 and staged() == before


def test_workspace():
    shared = fake_session(**{"spark.checkpoint.dir": "s3a://bucket/w/", "spark.master": "yarn"})
    assert workspace(shared) == "s3a://bucket/w"
    with pytest.raises(ValueError, match="shared by all executors"):
        workspace(fake_session(**{"spark.master": "yarn"}))
    local = fake_session(**{"spark.master": "local[2]"})
    assert workspace(local) == workspace(local)


def test_years_are_pruned_from_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "incidents")
    write_by_year(clean_incidents(raw_incidents(spark, SF)), path)
    table = spark.read.parquet(path)
    kept = in_years(table, "Start_Time", [1996, 1997], "start_year").select("City")
    assert re.search(r"PartitionFilters: \[[^\]]*start_year", plan(kept))
    assert set(glob.glob(f"{path}/start_year=*")) >= {f"{path}/start_year=1996"}
    full = in_years(raw_incidents(spark, SF), "Start_Time", [1996, 1997])
    assert kept.count() == full.count() > 0


def test_years_do_not_depend_on_the_session_zone(spark, tmp_path):
    """Written in one zone and read in others, with and without the year folders."""
    path, zone = str(tmp_path / "incidents"), spark.conf.get("spark.sql.session.timeZone")
    moments = spark.sql("SELECT timestamp_seconds(1546300800 + id * 21600) AS Start_Time FROM range(-6, 1466)")
    write_by_year(moments, path)
    try:
        for other in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", other)
            table = spark.read.parquet(path)
            for years in ([2018], [2019], [2019, 2020]):
                with_folders = in_years(table, "Start_Time", years, "start_year")
                assert with_folders.count() == in_years(table, "Start_Time", years).count() > 0
            total = sum(in_years(table, "Start_Time", [y], "start_year").count() for y in (2018, 2019, 2020))
            assert total == table.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_year_folders_hold_few_files(spark, tmp_path):
    path = str(tmp_path / "incidents")
    write_by_year(clean_incidents(raw_incidents(spark, SF)).repartition(16), path)
    years = glob.glob(f"{path}/start_year=*")
    assert len(glob.glob(f"{path}/start_year=*/*.parquet")) == len(years)


def _three_years(spark):
    """Six tasks with rows of three years each, and one with a row of none."""
    return spark.range(0, 6000, 1, 6).selectExpr(
        "CAST(id AS STRING) AS ID", "timestamp_seconds(1400000000 + id % 3 * 31536000) AS Start_Time"
    ).unionByName(spark.sql("SELECT 'none' AS ID, CAST(NULL AS TIMESTAMP) AS Start_Time"))


_LOGGED = """
import sys
from pyspark.sql import SparkSession
sys.path[:0] = sys.argv[3:]
from incidentry.plans.clean import write_by_year
from test_storage_and_jobs import _three_years
logged = {"enabled": "true", "dir": sys.argv[1], "compress": "false", "rolling.enabled": "false"}
settings = {f"spark.eventLog.{k}": v for k, v in logged.items()} | {"spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC"}
spark = SparkSession.builder.master("local[2]").config(map=settings).getOrCreate()
for compact in (True, False):
    write_by_year(_three_years(spark), f"{sys.argv[2]}/{compact}", compact=compact)
spark.stop()
"""


def test_years_are_stored_without_a_shuffle_or_sort(spark, tmp_path):
    """Both grow with whole rows: a shuffle carries all 47 columns, and a sort spills them."""
    (tmp_path / "log").mkdir()
    here = os.path.dirname(os.path.abspath(__file__))
    subprocess.run(
        [sys.executable, "-c", _LOGGED, str(tmp_path / "log"), str(tmp_path), here, os.path.dirname(here)],
        check=True, timeout=300, stdin=subprocess.DEVNULL,
    )
    events = [json.loads(line) for log in (tmp_path / "log").iterdir() for line in log.open()]
    plans = [e["physicalPlanDescription"] for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart")]
    assert sum("InsertIntoHadoopFsRelationCommand" in p for p in plans) == 3  # one puts files together
    assert not [p for p in plans if re.search(r"Exchange|\bSort\b", p)]
    ended = [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert sum(m["Shuffle Write Metrics"]["Shuffle Bytes Written"] + m["Memory Bytes Spilled"] for m in ended) == 0
    for compact, per_year in ((True, 1), (False, 6)):
        table = spark.read.parquet(f"{tmp_path}/{compact}")
        assert table.select("ID").distinct().count() == table.count() == 6001
        assert rows(table.groupBy("start_year").count()) == [(2014, 2000), (2015, 2000), (2016, 2000), (None, 1)]
        files = [len(glob.glob(f"{tmp_path}/{compact}/start_year=*{y}*/*.parquet")) for y in (2014, 2015, 2016, "HIVE")]
        assert files == [per_year] * 3 + [1]


def test_the_session_keeps_its_settings(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        write_by_year(_three_years(spark), str(tmp_path / "good"))
        assert spark.conf.get(name) == "3"
        with pytest.raises(PySparkException):
            write_by_year(_three_years(spark).selectExpr("raise_error(ID) AS ID", "Start_Time"), str(tmp_path / "bad"))
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.set(name, before)


def test_only_years_in_small_files_are_written_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clean, "_SMALL_FILE", 0)
    path = str(tmp_path / "large")
    write_by_year(_three_years(spark), path)
    assert len(glob.glob(f"{path}/start_year=*/*.parquet")) == 19
    monkeypatch.setattr(clean, "_SMALL_FILE", 8 << 20)
    monkeypatch.setattr(clean, "_FILE", 8 << 10)  # larger than a task should write: a year takes several
    path = str(tmp_path / "small")
    write_by_year(_three_years(spark), path)
    for year in (2014, 2015, 2016):
        assert 1 < len(glob.glob(f"{path}/start_year={year}/*.parquet")) < 6
    assert spark.read.parquet(path).count() == 6001


def test_more_years_than_files_kept_open(spark, tmp_path):
    path = str(tmp_path / "incidents")
    write_by_year(spark.sql("SELECT id, make_timestamp(1980 + id % 40, 6, 1, 0, 0, 0) AS Start_Time FROM range(0, 400, 1, 3)"), path)
    assert rows(spark.read.parquet(path).groupBy("start_year").count()) == [(y, 10) for y in range(1980, 2020)]
    assert len(glob.glob(f"{path}/start_year=*/*.parquet")) == 40


@pytest.fixture(scope="module")
def raw_csv(spark, tmp_path_factory):
    """A raw CSV as downloaded: gaps, quotes, backslashes, 47 columns."""
    root = str(tmp_path_factory.mktemp("raw"))
    raw = raw_incidents(spark, SF).withColumn("Start_Time", F.col("Start_Time").cast("timestamp"))
    save_result(raw, root, "accidents", "csv")
    save_result(population(spark, SF), root, "population", "csv")
    save_result(election(spark, SF), root, "election", "csv")
    return root


@pytest.fixture(scope="module")
def cleaned(spark, raw_csv, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("clean"))
    run(spark, ["clean", "--input", f"{raw_csv}/accidents", "--input-format", "csv", "--output", out])
    return out


def test_clean_job(spark, raw_csv, cleaned):
    table = spark.read.parquet(f"{cleaned}/incidents")
    assert table.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert table.filter(F.col("Description").contains("\\")).count() == 0
    earliest = table.select(F.min("Weather_Timestamp").cast("string"))
    assert rows(earliest) == [("0001-01-01 00:00:00",)]
    before = {r["column_name"] for r in load_result(spark, cleaned, "missingBefore").collect()}
    after = {r["column_name"] for r in load_result(spark, cleaned, "missingAfter").collect()}
    assert {"City", "Temperature(F)", "Wind_Direction"} <= before - after
    assert "End_Time" in after  # has no default


def values(frame) -> tuple[list, list]:
    """Column names, and the rows with numbers to six digits and days as text, sorted."""

    def plain(v):
        if v is None or isinstance(v, (str, bool)):
            return v
        return round(float(v), 6) if isinstance(v, (int, float)) else str(v)

    names = sorted(frame.column_names)
    found = zip(*[frame.column(n).to_pylist() for n in names], strict=True)
    return names, sorted((tuple(map(plain, row)) for row in found), key=repr)


# Result of a job, and the query whose SQL it must equal.
RESULTS = {
    "time": {
        "mostMonth": "month_count", "weekday": "weekday", "mostHour": "most_hour", "north_south": "north_south",
        "northCount": "north_count", "southCount": "south_count", "most_day_city": "most_day_city",
        "most_day_city_weather": "most_day_city_weather", "la_1223_weather": "day_weather", "red_blue": "red_blue",
        "mostDangeRoad": "dangerous_roads", "yearCount": "year_count",
    },
    "address": {
        "SideAndSeverityCount": "side_and_severity", "CityCount": "city_count", "StateCount": "state_count",
        "CityAvg": "city_average", "Timezone": "timezone", "LeftSide": "left_side", "CityCountBounds": "city_count_bounds",
        "TimezoneShare": "timezone_share",
    },
    "roadside": {
        "AvgVisi": "average_visibility", "numPOI": "poi_presence", "SevHasPOI": "severity_with_poi",
        "SevNoPOI": "severity_without_poi", "countPOI": "poi_totals", "countSev": "poi_totals_by_severity",
        "countSevLong": "poi_long",
    },
    "weather": {
        "WeatherDensity": "weather_density", "WeatherDensitySummary": "weather_summary", "WeatherCondition": "sky_counts",
        "WeatherConditionOther": "sky_counts_with_other", "WeatherWind": "wind_counts", "WeatherConditionMix": "sky_mix",
        "WeatherWindMix": "wind_mix", "WeatherConditionPies": "sky_pies",
    },
}
BY_HAND = {"north_south", "CityAvg"}  # of so few rows that they may be empty


@pytest.mark.parametrize("job", RESULTS)
def test_report_jobs(spark, raw_csv, cleaned, tmp_path, job):
    """Every stored result of a job equals its SQL over the same line items."""
    con, oracle = duck(SF), all_oracles()
    peaks = con.sql(oracle["report_most_day_city"] + " ORDER BY count DESC, date, city LIMIT 1").fetchall()[0]
    run(spark, [
        job, "--input", f"{cleaned}/incidents", "--output", str(tmp_path),
        "--population", f"{raw_csv}/population", "--election", f"{raw_csv}/election",
        "--years", "1996", "1997", "1998", "--cutoff-year", "2000", "--day", str(peaks[0]), "--city", peaks[1],
    ])
    for name, query in RESULTS[job].items():
        want = values(con.sql(oracle[f"report_{query}"]).to_arrow_table())
        stored = load_result(spark, str(tmp_path), name)
        assert values(stored.toArrow()) == want, name
        assert want[1] or name in BY_HAND


@pytest.mark.parametrize("job, results", [
    ("severity-raw", ["dtPrediction", "dtMetrics", "Sev1Prediction", "dtMapActual", "dtMapPredicted"]),
    ("severity", ["dtPrediction", "dtMetrics", "Sev1Prediction", "Sev2Prediction", "Sev3Prediction"]),
    ("rebalanced", ["PredResults_overunder", "PredMetrics_overunder", "PredS1_overunder",
                    "PredS2_overunder", "PredS3_overunder"]),
    ("rebalanced --class-weights", ["PredResults_overunder", "PredMetrics_overunder"]),
])
def test_model_jobs(spark, cleaned, tmp_path, job, results):
    run(spark, [*job.split(), "--input", f"{cleaned}/incidents", "--output", str(tmp_path), "--cutoff-year", "2000"])
    stored = {name: load_result(spark, str(tmp_path), name) for name in results}
    assert all(df.count() > 0 for df in stored.values())
    if "dtMapActual" in results:  # every scored row is on the map once a level
        levels = {r["zoom"]: r["n"] for r in stored["dtMapActual"].groupBy("zoom").agg(F.sum("count").alias("n")).collect()}
        assert set(levels.values()) == {stored["dtPrediction"].count()} and set(levels) == set(range(4, 13))


def test_a_failed_replacement_leaves_the_old_result(spark, tmp_path):
    root = str(tmp_path)
    replace_result(spark.createDataFrame([(1, "a")], "n int, t string"), root, "r")
    bad = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("n")
    )
    with pytest.raises(PySparkException, match="lost"):
        replace_result(bad, root, "r")
    assert rows(load_result(spark, root, "r")) == [(1, "a")]


def test_replaced_results_keep_the_last_versions(spark, tmp_path):
    root = str(tmp_path)
    reader = None
    for n in range(5):
        replace_result(spark.range(n, n + 1), root, "r", kept=2)
        if reader is not None:  # one that began before the replacement
            assert rows(reader) == [(n - 1,)]
        reader = load_result(spark, root, "r")
    assert rows(reader) == [(4,)]
    assert len(glob.glob(f"{root}/r/version-*")) == 2 == len(glob.glob(f"{root}/r/_published/0*"))
    replace_result(spark.range(3).selectExpr("CAST(id AS STRING) AS t"), root, "c", "csv", single_file=True)
    assert rows(load_result(spark, root, "c", "csv")) == [("0",), ("1",), ("2",)]
    # a note that is still being written, and one whose number another writer took
    (tmp_path / "r" / "_published" / "0000000009").write_text("version-half")
    assert rows(load_result(spark, root, "r")) == [(4,)]
    replace_result(spark.range(7, 8), root, "r")
    (tmp_path / "r" / "_published" / "0000000009").unlink(missing_ok=True)
    assert rows(load_result(spark, root, "r")) == [(7,)]
    save_result(spark.range(2), root, "plain")  # results stored without versions are read as before
    assert rows(load_result(spark, root, "plain")) == [(0,), (1,)]


def test_only_changed_years_are_rolled_up_again(spark, raw_csv, tmp_path):
    """A new year and a changed one are read; the reports equal those of a full run."""
    table, store = str(tmp_path / "incidents"), str(tmp_path / "rollups")
    cleaned = clean_incidents(raw_incidents(spark, SF))
    people = read_csv(spark, f"{raw_csv}/population", POPULATION_SCHEMA)
    states = read_csv(spark, f"{raw_csv}/election")
    write_by_year(cleaned.filter("year(Start_Time) < 1998"), table)
    read = []

    def reports():
        read.clear()
        kept = YearlyRollups(spark, table, store)
        get = kept.get

        def watched(build, name, depends_on=()):
            return get(lambda rows: read.append((name, tuple(rows.inputFiles()))) or build(rows), name, depends_on)

        kept.get = watched
        incidents = spark.read.parquet(table)
        found = time_reports(incidents, people, states, (1996, 1997, 1998), stage=stage, kept=kept)
        found |= {f"a{k}": v for k, v in address_reports(incidents, people, 2000, stage, kept).items()}
        found |= {f"r{k}": v for k, v in roadside_reports(incidents, 2000, stage, kept).items()}
        return {name: values(df.toArrow()) for name, df in found.items()}

    def folders_read():
        return {re.search(r"start_year=(\d+)", f).group(1) for _, files in read for f in files}

    reports()
    assert folders_read() == {os.path.basename(f)[11:] for f in glob.glob(f"{table}/start_year=*")}
    reports()
    assert folders_read() == set()
    late = cleaned.filter("year(Start_Time) = 1998").withColumn("start_year", F.lit(1998))
    late.write.mode("append").partitionBy("start_year").parquet(table)
    cleaned.limit(9).withColumn("start_year", F.lit(1995)).write.mode("append").partitionBy("start_year").parquet(table)
    again = reports()
    assert folders_read() == {"1995", "1998"}
    incidents = spark.read.parquet(table)
    full = time_reports(incidents, people, states, (1996, 1997, 1998))
    full |= {f"a{k}": v for k, v in address_reports(incidents, people, 2000).items()}
    full |= {f"r{k}": v for k, v in roadside_reports(incidents, 2000).items()}
    assert set(again) == set(full)
    for name, df in full.items():
        assert values(df.toArrow()) == again[name], name
    assert len(glob.glob(f"{store}/address/start_year=1995/*")) == 1  # the earlier state of the year is gone
    address_reports(incidents, people, 1997, stage, YearlyRollups(spark, table, store))
    assert len(glob.glob(f"{store}/address/start_year=1995/*")) == 2  # another rule has parts of its own


def test_jobs_with_kept_rollups(spark, raw_csv, cleaned, tmp_path):
    common = [
        "address", "--input", f"{cleaned}/incidents", "--population", f"{raw_csv}/population", "--cutoff-year", "2000",
    ]
    run(spark, [*common, "--output", f"{tmp_path}/a"])
    for _ in range(2):
        run(spark, [*common, "--output", f"{tmp_path}/b", "--rollups", f"{tmp_path}/kept"])
    for name in RESULTS["address"]:
        one, other = (values(load_result(spark, f"{tmp_path}/{x}", name).toArrow()) for x in "ab")
        assert one == other
    with pytest.raises(SystemExit):
        run(spark, [*common, "--output", f"{tmp_path}/c", "--rollups", "x", "--input-format", "csv"])


def test_only_folders_near_the_peaks_are_opened(spark, tmp_path):
    """Folders of other years hold a file that cannot be read."""
    path = str(tmp_path / "incidents")
    write_by_year(clean_incidents(raw_incidents(spark, SF)), path)
    table = spark.read.parquet(path)
    peaks = stage(time.most_day_city(time.city_days(table, [1995]), 3, 4), "peaks")
    want = rows(time.most_day_city_weather(table, peaks))
    assert len(want) > 0
    far = [f for f in glob.glob(f"{path}/start_year=*") if not 1994 <= int(f[-4:]) <= 1996]
    assert len(far) > 1
    for folder in far:
        with open(f"{folder}/bad.parquet", "w") as file:
            file.write("nothing of the kind")
    broken = spark.read.schema(table.schema).parquet(path)
    found = time.most_day_city_weather(broken, peaks)
    assert "start_year" in re.search(r"PartitionFilters: \[[^\]]*\]", plan(found)).group(0)
    assert rows(found) == want
    with pytest.raises(Exception, match="bad.parquet"):
        broken.select("City").collect()


def test_job_needs_its_dimensions(spark, cleaned, tmp_path):
    with pytest.raises(SystemExit):
        run(spark, ["address", "--input", f"{cleaned}/incidents", "--output", str(tmp_path)])
