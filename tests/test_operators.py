import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from incidentry import (
    attach_attribute,
    average_and_max,
    average_by,
    cohort_compare,
    count_by,
    density_curve,
    distribution,
    drop_sentinels,
    fill_defaults,
    flag_totals,
    geo_grid,
    histogram,
    keep_above,
    null_report,
    pivot_counts,
    preview,
    rate_by_dimension,
    share,
    strip_chars,
    summarise,
    top_group_peaks,
    tile_pyramid,
    top_k,
    two_level_rate,
    value_bounds,
)


def test_null_report_sees_null_and_nan_and_awkward_names(spark):
    df = spark.createDataFrame(
        [(1, None, float("nan"), "x"), (2, None, 1.0, "y"), (3, "a", None, "z")],
        "id int, `Distance(mi)` string, m double, full string",
    )
    assert rows(null_report(df)) == [("Distance(mi)", 2), ("m", 2)]
    assert rows(null_report(df, ["id", "full"])) == []


def test_fill_then_filter(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 5.0, "N"), (2, 0.0, None), (3, None, "S"), (4, nan, "E")], "id int, m double, wind string"
    )
    defaults = {"m": -999.0, "wind": "windEmpty"}
    filled = fill_defaults(df, defaults)
    assert rows(filled) == [(1, 5.0, "N"), (2, 0.0, "windEmpty"), (3, -999.0, "S"), (4, -999.0, "E")]
    assert rows(null_report(filled)) == []
    assert rows(drop_sentinels(filled, defaults)) == [(1, 5.0, "N")]
    assert rows(drop_sentinels(df, {"m": -999.0})) == [(1, 5.0, "N"), (2, 0.0, None)]
    assert rows(keep_above(filled, {"m": -900.0}).select("id")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no such columns"):
        fill_defaults(df, {"nope": 1})


def test_fill_timestamps(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS a, CAST(NULL AS TIMESTAMP_NTZ) AS b")
    filled = fill_defaults(df, {"a": "0001-01-01 00:00:00", "b": "0001-01-01 00:00:00"})
    texts = filled.select(F.col("a").cast("string"), F.col("b").cast("string"))
    assert rows(texts) == [("0001-01-01 00:00:00", "0001-01-01 00:00:00")]


def test_strip_backslashes(spark):
    df = spark.createDataFrame([("a\\b\\\\c",), (None,)], "t string")
    assert [r["t"] for r in strip_chars(df, "t").collect()] == ["abc", None]


def test_weighted_and_plain_aggregates_agree(spark):
    data = [("a", 1), ("a", 3), ("a", None), ("b", 2), (None, 5)]
    df = spark.createDataFrame(data, "k string, v int")
    rollup = count_by(df, ["k", "v"], "n")
    assert rows(count_by(df, ["k"])) == rows(count_by(rollup, ["k"], weight="n"))
    plain = summarise(df, ["k"], "v", 2)
    assert rows(plain) == rows(summarise(rollup, ["k"], "v", 2, weight="n"))
    assert rows(plain) == [("a", 2, 2.0), ("b", 1, 2.0), (None, 1, 5.0)]


def test_flag_totals_leave_the_key_out_of_the_sums(spark):
    df = spark.createDataFrame(
        [(1, True, False), (1, True, None), (2, False, True)], "severity int, a boolean, b boolean"
    )
    assert flag_totals(df, ["a", "b"], ["severity"]).columns == ["severity", "a", "b"]
    assert rows(flag_totals(df, ["a", "b"], ["severity"])) == [(1, 2, 0), (2, 0, 1)]
    assert rows(flag_totals(df, ["a", "b"])) == [(2, 1)]


def test_average_ignores_sentinels(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 0.0), (1, -999.0), (2, None)], "s int, v double")
    assert rows(average_by(df, ["s"], "v", at_least=0.0)) == [(1, 5.0)]


def test_value_bounds(spark):
    df = spark.createDataFrame([(10,), (20,)], "v int")
    low, high = value_bounds(df, "v").first()
    assert (low, high) == (pytest.approx(9.0), pytest.approx(22.0))


def test_top_k_breaks_ties_by_key_and_needs_support(spark):
    df = spark.createDataFrame([("c", 5, 1), ("a", 5, 9), ("b", 5, 9), ("d", 9, 1)], "k string, v int, n int")
    assert [r["k"] for r in top_k(df, "v", 3, ["k"]).collect()] == ["d", "a", "b"]
    assert [r["k"] for r in top_k(df, "v", 3, ["k"], ("n", 1)).collect()] == ["a", "b"]
    assert [r["k"] for r in preview(df, ["k"], 2).collect()] == ["a", "b"]
    assert "TakeOrderedAndProject" in plan(top_k(df, "v", 3, ["k"]))


def test_peaks_of_the_largest_groups(spark):
    data = [("x", 1)] * 3 + [("x", 2)] + [("y", 1)] * 2 + [("z", 1)] + [(None, 1)] * 9
    df = spark.createDataFrame([(*d, f"w{i}") for i, d in enumerate(data)], "city string, day int, w string")
    peaks = top_group_peaks(df, "city", "day", k_groups=2, k_days=2)
    assert [tuple(r) for r in peaks.collect()] == [(1, "x", 3), (1, "y", 2)]
    attached = attach_attribute(peaks, df, ["city", "day"], ["w"])
    assert rows(attached.select("city", "count", "w")) == [
        ("x", 3, "w0"), ("x", 3, "w1"), ("x", 3, "w2"), ("y", 2, "w4"), ("y", 2, "w5"),
    ]
    assert rows(attach_attribute(peaks, df, ["city", "day"], ["w"])) == rows(attached)


def test_peaks_read_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id % 7 AS city", "id % 3 AS day").write.parquet(path)
    peaks = top_group_peaks(spark.read.parquet(path), "city", "day")
    peaks.collect()
    final = plan(peaks).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_cohorts_drop_keys_one_side_lacks(spark):
    df = spark.createDataFrame([(1, 50.0), (1, 30.0), (2, 50.0), (3, 37.0), (None, 50.0)], "m int, lat double")
    sides = {"north": F.col("lat") > 40, "south": F.col("lat") < 35}
    assert rows(cohort_compare(df, "m", sides)) == [(1, 1, 1)]
    rollup = count_by(df, ["m", "lat"], "n")
    assert rows(cohort_compare(rollup, "m", sides, weight="n")) == [(1, 1, 1)]


def test_rates_with_missing_unmatched_and_empty_dimensions(spark):
    counts = spark.createDataFrame([("A", 10), ("B", 4), ("C", 1), (None, 7)], "state string, n int")
    pops = spark.createDataFrame([("A", 4), ("B", 0), ("D", 9)], "st string, pop int")
    got = rate_by_dimension(counts, pops, ("state", "st"), "n", "pop", digits=2)
    assert got.columns == ["state", "n", "pop", "rate"]
    assert rows(got) == [("A", 10, 4, 2.5), ("B", 4, 0, None)]


def test_two_level_rate(spark):
    facts = spark.createDataFrame([("A",)] * 3 + [("B",)] + [("X",)] * 5, "State string")
    pops = spark.createDataFrame([("A", 10), ("B", 20), ("C", 30)], "state string, pop int")
    colours = spark.createDataFrame(
        [("A", "red"), ("B", "blue"), ("C", "red"), ("E", "grey")], "state string, color string"
    )
    got = two_level_rate(facts, "State", pops, colours, "state", "color", "pop", 3)
    assert rows(got) == [("blue", 20, 1, 0.05), ("red", 40, 3, 0.075)]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), (None, 1, 4)], "k string, s int, n int")
    assert rows(share(df, "n").select("s", "n", "share")) == [(1, 1, 0.125), (1, 4, 0.5), (2, 3, 0.375)]
    within = share(df, "n", ["k"])
    assert within.columns == ["k", "s", "n", "share"]
    assert rows(within) == [("a", 1, 1, 0.25), ("a", 2, 3, 0.75), (None, 1, 4, 1.0)]


def test_pivot_counts_absent_cells_as_zero(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 3)], "k string, s int")
    got = pivot_counts(df, ["k"], "s", {1: "s1", 2: "s2", 3: "s3"})
    assert rows(got) == [("a", 2, 0, 0), ("b", 0, 0, 1)]


def test_histogram_and_grid_floor_negative_values(spark):
    df = spark.createDataFrame(
        [(1, -0.1, 10.0), (1, 0.0, -10.1), (1, None, 0.0), (1, float("nan"), 0.0)], "s int, v double, w double"
    )
    assert rows(histogram(df, ["s"], "v", 0.0, 0.5)) == [(1, -1, 1), (1, 0, 1)]
    assert rows(geo_grid(df.limit(2), "w", "v", 5.0)) == [(-3, 0, 1), (2, -1, 1)]


def expected_summary(values):
    return (
        len(values), min(values), *np.quantile(values, [0.25, 0.5, 0.75]), max(values),
        statistics.fmean(values), statistics.stdev(values) if len(values) > 1 else None,
    )


def test_distribution_against_brute_force(spark):
    """A hot key, ties, few rows, one row, a null key, gaps and an empty measure."""
    rng = random.Random(5)
    data = [("hot", rng.gauss(0, 1), float(rng.randrange(3))) for _ in range(6000)]
    data += [("tied", 7.0, 1.0)] * 50 + [("pair", 1.0, 2.0), ("pair", 4.0, None)]
    data += [("single", 3.0, None), (None, 1.0, 1.0), (None, 2.0, float("nan"))]
    df = spark.createDataFrame(data, "k string, a double, b double").repartition(7)
    got = distribution(df, "k", ["a", "b"])
    assert got.columns == ["k", "measure", "n", "min", "p25", "p50", "p75", "max", "mean", "stddev"]
    result = {(r["k"], r["measure"]): tuple(r)[2:] for r in got.collect()}
    want = {}
    for i, measure in ((1, "a"), (2, "b")):
        for key in {d[0] for d in data}:
            values = [d[i] for d in data if d[0] == key and d[i] is not None and d[i] == d[i]]
            if values:
                want[key, measure] = expected_summary(values)
    assert set(result) == set(want)
    for group, numbers in want.items():
        assert result[group] == pytest.approx(numbers, abs=1e-9), group


@pytest.mark.parametrize(("bounded", "accuracy", "steps"), [(5, 20, 10), (40, 50, 1000), (1, 10, 4)])
def test_open_ranks_are_narrowed_until_few_values_are_left(spark, monkeypatch, bounded, accuracy, steps):
    """Poor cuts and a small bound: several narrowings, the same exact quantiles."""
    from incidentry.operators import distribution as module

    seen = []
    narrowed = module._narrowed
    monkeypatch.setattr(module, "_narrowed", lambda *a: seen.append(1) or narrowed(*a))
    monkeypatch.setattr(module, "_BOUNDED", bounded)
    monkeypatch.setattr(module, "_ACCURACY", accuracy)
    monkeypatch.setattr(module, "_STEPS", steps)
    rng = random.Random(bounded)
    data = [("hot", rng.gauss(0, 1), rng.expovariate(1e-3)) for _ in range(3000)]
    data += [("ties", float(rng.choice([1, 1, 1, 2, 5])), rng.random()) for _ in range(500)] + [(None, 1.0, -0.0), (None, 2.0, 3.0)]
    df = spark.createDataFrame(data, "k string, a double, b double").repartition(5)
    got = {(r["k"], r["measure"]): tuple(r)[2:] for r in distribution(df, "k", ["a", "b"]).collect()}
    assert seen and len(got) == 6
    for i, measure in ((1, "a"), (2, "b")):
        for key in ("hot", "ties", None):
            want = expected_summary([d[i] for d in data if d[0] == key])
            assert got[key, measure] == pytest.approx(want, abs=1e-9)


def test_density_curve_against_the_sum_of_all_kernels(spark):
    rng = random.Random(3)
    inf, nan = float("inf"), float("nan")
    data = [("a", rng.gauss(5, 2), rng.choice([0.0, 10.0])) for _ in range(700)] + [("a", inf, nan), ("a", None, -inf)]
    data += [("spike", 1.0, None)] * 60 + [("spike", 400.0, None), (None, 1.0, 2.0), (None, 4.0, 2.0), ("one", 7.0, None)]
    got = density_curve(spark.createDataFrame(data, "k string, x double, y double").repartition(4), "k", ["x", "y"], points=37)
    assert got.columns == ["k", "measure", "point", "value", "density", "bandwidth"]
    curves = {}
    for r in got.collect():
        curves.setdefault((r["k"], r["measure"]), {})[r["point"]] = (r["value"], r["density"], r["bandwidth"])
    assert set(curves) == {("a", "x"), ("a", "y"), ("spike", "x"), (None, "x"), (None, "y"), ("one", "x")}
    for (key, measure), points in curves.items():
        values = np.array([v for d in data if d[0] == key and (v := d[1 if measure == "x" else 2]) is not None])
        values = values[np.isfinite(values)]
        if len(set(values)) == 1:
            assert points == {0: (values[0], None, 0.0)}
            continue
        quartiles = np.quantile(values, [0.25, 0.75])
        h = 1.059 * min(values.std(ddof=1), (quartiles[1] - quartiles[0]) / 1.349) * len(values) ** -0.2
        h = max(h, (values.max() - values.min()) / 100)
        grid = np.linspace(values.min() - 2 * h, values.max() + 2 * h, 37)
        kernels = np.exp(-0.5 * ((grid[:, None] - values[None, :]) / h) ** 2).sum(1) / (len(values) * h * math.sqrt(2 * math.pi))
        assert sorted(points) == list(range(37))
        found = np.array([points[i] for i in range(37)])
        assert np.allclose(found[:, 0], grid, atol=1e-9) and np.allclose(found[:, 2], h, atol=1e-12)
        assert np.abs(found[:, 1] - kernels).max() < 1e-10 * kernels.max()
    assert density_curve(spark.createDataFrame([], "k string, x double"), "k", ["x"]).collect() == []


def test_distribution_of_other_quantiles(spark):
    df = spark.range(1001).selectExpr("'k' AS k", "CAST(id AS DOUBLE) AS v")
    got = distribution(df, "k", ["v"], {0.0: "q0", 0.1: "q10", 1.0: "q100"})
    assert rows(got.select("q0", "q10", "q100")) == [(0.0, 100.0, 1000.0)]


def test_distribution_of_infinite_values(spark):
    inf = float("inf")
    data = [("a", v) for v in (-inf, 1.0, 2.0, inf, inf)] + [("b", inf)] + [("c", -inf), ("c", 5.0)]
    got = distribution(spark.createDataFrame(data, "k string, v double"), "k", ["v"])
    assert rows(got.select("k", "p25", "p50", "p75")) == [
        ("a", 1.0, 2.0, inf), ("b", inf, inf, inf), ("c", -inf, -inf, -inf),
    ]


def test_nan_is_missing_in_every_measure(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", nan, 3.0), ("a", 4.0, nan)], "k string, v double, w double")
    assert rows(average_by(df, ["k"], "v", at_least=0.0)) == [("a", 2.5)]
    assert rows(average_and_max(df, ["k"], "v")) == [("a", 2.5, 4.0)]
    assert rows(value_bounds(df, "v", 1.0, 1.0)) == [(1.0, 4.0)]
    assert rows(keep_above(df, {"v": 0.0}).select("v")) == [(1.0,), (4.0,)]
    assert rows(geo_grid(df, "v", "w", 1.0)) == [(1, 2, 1)]


def test_tile_pyramid_against_each_level(spark):
    """Edges of the map, poles, points beyond it and points that are nowhere."""
    rng = random.Random(8)
    nan, inf = float("nan"), float("inf")
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.choice("ab")) for _ in range(400)]
    points += [(0.0, 0.0, "a"), (90.0, 180.0, "a"), (-90.0, -180.0, "b"), (86.0, 500.0, "b"), (10.0, -500.0, None)]
    lost = [(None, 1.0, "a"), (1.0, None, "a"), (nan, 1.0, "a"), (1.0, nan, "b"), (inf, 1.0, "b"), (1.0, -inf, "b")]
    df = spark.createDataFrame([*points, *lost], "lat double, lon double, k string")
    want = Counter()
    for lat, lon, k in points:
        lat = max(min(lat, 85.05112878), -85.05112878)
        for z in range(2, 8):
            x = (lon + 180) / 360 * 2**z
            y = (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * 2**z
            x, y = (int(max(0, min(math.floor(v), 2**z - 1))) for v in (x, y))
            quadkey = "".join(str((x >> i & 1) + 2 * (y >> i & 1)) for i in range(z - 1, -1, -1))
            want[k, z, x, y, quadkey] += 1
    tiles = tile_pyramid(df, "lat", "lon", ["k"], 2, 7, out="n")
    assert tiles.columns == ["k", "zoom", "x", "y", "quadkey", "n"]
    assert {tuple(r)[:5]: r["n"] for r in tiles.collect()} == want
    assert plan(tile_pyramid(df, "lat", "lon")).count("Scan") == 1
    assert tile_pyramid(df.limit(0), "lat", "lon").collect() == []
