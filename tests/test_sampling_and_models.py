import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from incidentry import (
    WHOLE_ROW,
    accuracy,
    class_counts,
    class_weights,
    confusion,
    load_model,
    oversample,
    oversample_random,
    save_model,
    scores,
    split,
    train_and_score,
    undersample,
    union_all,
    weighted_f1,
)
from incidentry.operators.sampling import unit_hash
from incidentry.plans import prediction


@pytest.fixture(scope="module")
def classes(spark):
    """Class sizes 1000 / 100 / 10 / 1 and a null label."""
    sizes = {1: 1000, 2: 100, 3: 10, 4: 1, None: 5}
    data = [(f"{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "id string, label int")


def sizes_of(df):
    return {r["label"]: r["count"] for r in class_counts(df, "label").collect()}


def test_hash_sampling_does_not_depend_on_partitioning(classes):
    pick = lambda df: rows(undersample(df, "label", {1: 0.4, 2: 1.0}, "id", 3))
    assert pick(classes.repartition(1)) == pick(classes.repartition(7))
    assert pick(classes) != rows(undersample(classes, "label", {1: 0.4, 2: 1.0}, "id", 4))


def test_undersampling_keeps_fractions_and_drops_other_classes(classes):
    for key in ("id", None):
        got = sizes_of(undersample(classes, "label", {1: 0.4, 2: 1.0}, key, 3))
        assert set(got) == {1, 2} and got[2] == 100
        assert 330 < got[1] < 470


def test_unit_hash_is_uniform(spark):
    share = spark.range(4000).select((unit_hash("id", 1) < 0.25).cast("double").alias("x"))
    assert share.agg(F.avg("x")).first()[0] == pytest.approx(0.25, abs=0.03)


def test_oversampling_evens_the_classes_and_keeps_every_row(classes):
    more = oversample(classes, "label", "id", 3)
    assert more.columns == classes.columns
    assert sizes_of(more) == {1: 1000, 2: 1000, 3: 1000, 4: 1000, None: 5}  # rows without a class once
    copies = Counter(r["id"] for r in more.collect())
    assert len(copies) == 1116 and copies["1-0"] == 1 and copies["2-0"] == 10 and copies["4-0"] == 1000


def test_oversampling_by_a_broken_ratio(spark):
    data = [(f"a{i}", 1) for i in range(900)] + [(f"b{i}", 2) for i in range(400)]
    got = sizes_of(oversample(spark.createDataFrame(data, "id string, label int"), "label", "id"))
    assert got[1] == 900 and 840 < got[2] < 960  # 2.25 copies each


def test_oversampling_a_very_rare_class_spreads_its_copies(spark, monkeypatch):
    from incidentry.operators import sampling

    monkeypatch.setattr(sampling, "_COPIES_AT_ONCE", 50)
    data = [(f"a{i}", 1) for i in range(1010)] + [("b", 2)] + [(f"c{i}", 3) for i in range(3)]
    more = oversample(spark.createDataFrame(data, "id string, label int"), "label", "id")
    got = sizes_of(more)
    assert got[1] == 1010 and got[2] == 1010 and got[3] in (1008, 1009, 1010, 1011)
    assert "REBALANCE" in plan(more)  # by key and portion, so many portions are many tasks


def test_rows_without_key_or_class_have_a_rule(spark):
    data = [("a", 1), ("b", 1), ("c", 1), (None, 1), (None, 1), ("d", 2), ("e", None)]
    df = spark.createDataFrame(data, "id string, label int")
    train, test = split(df, 0.5, "id")
    assert train.count() + test.count() == 7
    assert undersample(df, "label", {1: 1.0, 2: 1.0}, "id").count() == 6
    got = oversample(df, "label", "id").collect()
    assert sum(r["label"] == 2 for r in got) == 5 and sum(r["label"] == 1 for r in got) == 5
    assert [r["id"] for r in got if r["label"] is None] == ["e"]


def test_random_oversampling(spark, classes, monkeypatch):
    from incidentry.operators import sampling

    for mean_at_once in (16, 3):  # a mean of 100 in 7 or in 34 portions
        monkeypatch.setattr(sampling, "_MEAN_AT_ONCE", mean_at_once)
        for key in ("id", WHOLE_ROW):
            drawn = oversample_random(classes, "label", [1, 2, 3], 10, key)
            got = sizes_of(drawn)
            assert set(got) == {1, 2, 3} and got[1] == 1000
            assert all(abs(got[c] - 1000) < 5 * 1000**0.5 for c in (2, 3))
            copies = Counter(r["id"] for r in drawn.collect())
            assert all(copies[f"1-{i}"] == 1 for i in range(1000))
            assert len({copies[f"2-{i}"] for i in range(100)}) > 5  # drawn, not evened
            again = oversample_random(classes.repartition(5), "label", [1, 2, 3], 10, key)
            assert rows(again) == rows(drawn)
    one_scan = plan(oversample_random(spark.range(50).selectExpr("id", "int(id % 7 = 0) AS c"), "c", [0, 1], 1, "id"))
    assert one_scan.count("Range (") == 1 and "Sample" not in one_scan
    assert oversample_random(classes.limit(0), "label", [1, 2], 10, "id").collect() == []


def test_copies_are_poisson_distributed(spark):
    """Of 4000 rows with a mean of 3 copies, the numbers of rows with 0, 1, .. copies."""
    df = spark.range(16000).selectExpr("id", "CASE WHEN id < 4000 THEN 1 ELSE 0 END AS c")
    copies = Counter(r["id"] for r in oversample_random(df, "c", [0, 1], 3, "id").collect() if r["c"] == 1)
    found = Counter(copies[i] for i in range(4000))
    for k in range(9):
        share = math.exp(-3) * 3**k / math.factorial(k)
        assert abs(found[k] - 4000 * share) < 5 * (4000 * share * (1 - share)) ** 0.5


def test_rows_without_a_key_go_their_own_ways(spark):
    """All keys null, a third of the rows equal, columns of every kind of text."""
    data = [(None, 1, "same", 0.0, None, [1, 2])] * 400 + [
        (None, i % 3, f"t{i}", -0.0 if i % 2 else 0.0, bytearray([255, i % 256]), [i, None]) for i in range(800)
    ]
    df = spark.createDataFrame(data, "id string, label int, text string, x double, raw binary, many array<int>")
    for key in ("id", WHOLE_ROW):
        train, test = split(df, 0.8, key, 3)
        assert abs(train.count() - 960) < 5 * (1200 * 0.16) ** 0.5
        assert abs(train.filter("text = 'same'").count() - 320) < 5 * 8
        assert rows(union_all([train, test])) == rows(df)  # every row once, no value changed
        assert rows(split(df.repartition(7), 0.8, key, 3)[0]) == rows(train)
        kept = sizes_of(undersample(df, "label", {0: 1.0, 1: 0.5}, key, 4))
        assert kept[0] == 267 and abs(kept[1] - 333) < 5 * 13 and set(kept) == {0, 1}
        assert set(sizes_of(oversample(df, "label", key, 4)).values()) <= set(range(600, 740))
    keyed = df.withColumn("id", F.lit("k"))
    assert split(keyed, 0.8, "id", 3)[0].count() in (0, 1200)  # rows of one key stay together
    assert abs(split(keyed, 0.8, WHOLE_ROW, 3)[0].count() - 960) < 5 * (1200 * 0.16) ** 0.5


def test_many_equal_rows_are_numbered_in_portions(spark, monkeypatch):
    from incidentry.operators import sampling

    monkeypatch.setattr(sampling, "_EQUAL_AT_ONCE", 7)
    df = spark.range(50).selectExpr("CAST(NULL AS STRING) AS id", "1 AS v")
    numbered = sampling.identified(df, "id")
    assert numbered.select("_identity").distinct().count() == numbered.count() == 50
    assert numbered.drop("_identity").columns == df.columns


def test_class_weights_stand_for_copies(classes):
    weighed = class_weights(classes, "label")
    assert weighed.columns == [*classes.columns, "weight"]
    assert {(r["label"], r["weight"]) for r in weighed.collect()} == {
        (1, 1.0), (2, 10.0), (3, 100.0), (4, 1000.0), (None, 1.0),
    }


def test_a_weighed_model_needs_no_copies(crashes, monkeypatch):
    """The same predictions as with copies, and the training rows that are staged are the split's."""
    from incidentry.operators import severity

    staged = {}
    keep = severity.stage
    monkeypatch.setattr(severity, "stage", lambda df, label: staged.setdefault(label, keep(df, label)))
    args = (crashes, prediction.rebalanced_model(5, "weight"), prediction.REBALANCED, True)
    _, weighed = prediction.fit_and_report(*args)
    train = staged.pop("train")
    assert train.select("ID").distinct().count() == train.count() and "weight" in train.columns
    staged.clear()
    _, copied = prediction.fit_and_report(crashes, prediction.rebalanced_model(5), *args[2:])
    assert staged["train"].count() > train.count()
    assert rows(weighed["predictions"]) == rows(copied["predictions"])


def test_splits_are_complete_and_apart(classes):
    for key in ("id", None):
        train, test = split(classes, 0.8, key, 5)
        a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
        assert not a & b and len(a | b) == classes.count()
        assert 0.74 < len(a) / len(a | b) < 0.86


def test_union_keeps_duplicates_and_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("x", 1)], "t string, n int")
    assert rows(union_all([a, b])) == [(1, "x"), (1, "x")]


def test_metrics_against_brute_force(spark):
    rng = random.Random(1)
    pairs = [(float(rng.randrange(4)), rng.randrange(1, 4)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "prediction double, label int")
    labels = Counter(l for _, l in pairs)
    total = 0.0
    for c, n in labels.items():
        hits = sum(p == l == c for p, l in pairs)
        total += n * 2 * hits / (n + sum(p == c for p, _ in pairs))
    right = sum(p == l for p, l in pairs) / 300
    assert weighted_f1(df, "prediction", "label").first()[0] == pytest.approx(total / 300)
    assert accuracy(df, "prediction", "label").first()[0] == pytest.approx(right)
    both = scores(confusion(df, "prediction", "label")).first()
    assert tuple(both) == (pytest.approx(right), pytest.approx(total / 300))
    assert sum(r["count"] for r in confusion(df, "prediction", "label").collect()) == 300


@pytest.fixture(scope="module")
def crashes(spark):
    """Feature rows whose severity follows from latitude and junction."""
    rng = random.Random(2)
    data = []
    for i in range(600):
        lat, junction = rng.uniform(25, 49), rng.randrange(2)
        severity = 3 if lat > 45 else 2 if junction else 1
        data.append((
            str(i), severity, 2016 + i % 4, 1 + i % 12, 1 + i % 7, i % 24, lat, rng.uniform(-124, -70),
            rng.uniform(0, 90), 29.0, 50.0, 10.0, junction, i % 2,
        ))
    return spark.createDataFrame(
        data,
        "ID string, Severity int, Year int, Month int, Weekday int, Hour int, Start_Lat double, "
        "Start_Lng double, `Temperature(F)` double, `Pressure(in)` double, `Humidity(%)` double, "
        "`Visibility(mi)` double, Junction int, Traffic_Signal int",
    )


@pytest.mark.parametrize("pipeline, width", [
    (prediction.severity_model, 51), (prediction.rebalanced_model, 50),
])
def test_model_learns_survives_saving_and_has_the_known_width(crashes, tmp_path, pipeline, width):
    train, test = split(crashes, 0.8, "ID")
    model, scored, metrics = train_and_score(train, test, pipeline(5))
    assert model.stages[-1].numFeatures == width and model.stages[-1].numClasses == 4
    assert model.transform(test).first()["features"].size == width
    values = {(r["split"], r["metric"]): r["value"] for r in metrics.collect()}
    assert set(values) == {(s, m) for s in ("train", "test") for m in ("accuracy", "weighted_f1")}
    assert all(0.95 < v <= 1.0 for v in values.values())
    assert scored.count() == test.count()
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model")).transform(test).select("ID", "prediction")
    assert rows(again) == rows(scored.select("ID", "prediction"))


def test_training_rows_are_dealt_out_to_all_cores(spark, crashes, monkeypatch):
    """Five files, which a scan would read in three tasks: four cores get one each, and the session keeps its settings."""
    from pyspark.ml import Pipeline

    seen = []
    fit = Pipeline.fit

    def spy(self, df):
        seen.append((df.rdd.getNumPartitions(), df.count()))
        return fit(self, df)

    monkeypatch.setattr(Pipeline, "fit", spy)
    train, test = split(crashes, 0.8, "ID")
    names = ("parquet.block.size", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(name, None) for name in names]
    train_and_score(train.repartition(5), test, prediction.rebalanced_model(2))
    assert seen == [(spark.sparkContext.defaultParallelism, train.count())]
    assert [spark.conf.get(name, None) for name in names] == before


def test_reports_of_a_rebalanced_model(crashes):
    model, out = prediction.fit_and_report(
        crashes, prediction.rebalanced_model(5), prediction.REBALANCED, rebalance=True
    )
    tested = out["predictions"].count()
    assert sum(r["count"] for r in out["confusion"].collect()) == tested > 50
    per_level = [prediction.actual_by_predicted(out["confusion"], level) for level in (1, 2, 3)]
    assert sum(r["count"] for df in per_level for r in df.collect()) == tested
