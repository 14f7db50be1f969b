"""Features, encoders, models and their evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from incidentry import (
    accuracy,
    class_weights,
    confusion,
    count_by,
    load_model,
    oversample,
    save_model,
    severity_pipeline,
    train_and_score,
    weighted_f1,
)
from incidentry.operators.sampling import split
from incidentry.plans import prediction
from incidentry.sources.workspace import fresh_path

from .common import SQL_PRIORITY, as_long, priority, rounded, sql_hash, sql_round, table
from .incidents import SQL_INCIDENTS, incidents

CUTOFF = 2000
_NUMBERS = [
    "Start_Lat", "Start_Lng", "Temperature(F)", "Pressure(in)", "Humidity(%)", "Visibility(mi)",
]


def features(spark, sf):
    return prediction.severity_features(incidents(spark, sf), CUTOFF)


def ml_feature_table(spark, sf):
    wide = as_long(
        features(spark, sf), "Severity", "Year", "Month", "Weekday", "Hour", "Junction", "Traffic_Signal"
    )
    return rounded(wide, 6, *_NUMBERS)


def ml_feature_table_monday(spark, sf):
    """The rebalanced model's features: other year rule, Monday first, no visibility."""
    rows = prediction.rebalanced_features(incidents(spark, sf), CUTOFF)
    wide = as_long(rows, "Severity", "Year", "Month", "Weekday", "Hour", "Junction", "Traffic_Signal")
    return rounded(wide, 6, *_NUMBERS[:-1])


def string_index(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority")
    indexer = severity_pipeline([], [], "label", indexed=["o_orderpriority"]).getStages()[0]
    indexed = indexer.fit(orders).transform(orders).withColumnRenamed("o_orderpriority_index", "position")
    return count_by(indexed, ["o_orderpriority", "position"], "n")


def feature_vector(spark, sf):
    """The sum of every position of the encoded vector, zeros included."""
    rows = features(spark, sf)
    encoder = Pipeline(stages=prediction.severity_model().getStages()[:-1])
    total = encoder.fit(rows).transform(rows).select(Summarizer.sum(F.col("features")).alias("v"))
    sums = total.select(F.posexplode(vector_to_array("v")).alias("position", "total"))
    return rounded(as_long(sums, "position"), 3, "total")


def model_predictions(spark, sf):
    """Scored test rows of the undersampled model.

    No SQL grows its tree; the same steps on a label that is a rule are compared in ``learned_rule_predictions``.
    """
    _, reports = prediction.severity_reports(incidents(spark, sf), CUTOFF)
    return reports["dtPrediction"]


def model_predictions_rebalanced(spark, sf):
    """Scored test rows of the rebalanced model, with its test accuracy.

    No SQL grows its tree; its training rows are compared in ``rebalanced_training_rows``, its steps in ``learned_rule_*``.
    """
    _, reports = prediction.rebalanced_reports(incidents(spark, sf), CUTOFF)
    return reports["PredResults_overunder"]


def model_metrics(spark, sf):
    """Accuracy and F1 of the model on raw classes, on both splits.

    No SQL grows its tree; the figures are compared in ``learned_rule_metrics``, ``accuracy_metric`` and ``f1_metric``.
    """
    _, reports = prediction.severity_reports(incidents(spark, sf), CUTOFF, sampled=False)
    return reports["dtMetrics"]


def _learned_rule(spark, sf):
    """A tree on a label that is a rule of one feature: it must learn it exactly.
    The priority goes in as text, through the pipeline's index and encoder, too."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", priority().cast("double").alias("step"),
        ((priority() * 7) % 4).cast("int").alias("label"),
    )
    train, test = split(rows, 0.8, "o_orderkey", 11)
    return train_and_score(train, test, severity_pipeline([], ["step"], "label", indexed=["o_orderpriority"]))


def learned_rule_predictions(spark, sf):
    _, scored, _ = _learned_rule(spark, sf)
    return as_long(scored.select("o_orderkey", "prediction"), "prediction")


def learned_rule_metrics(spark, sf):
    """Accuracy and F1 of a model that is right on every row of both splits."""
    _, _, metrics = _learned_rule(spark, sf)
    return rounded(metrics, 9, "value")


def weights_against_copies(spark, sf):
    """A tree trained on class weights and one on copies predict alike: rows per label, and differences.

    The label is a rule of the price that the tree can learn; class 3 is rare.
    """
    price = F.col("o_totalprice")
    label = F.when(price < 300000, 1).when(price < 450000, 2).otherwise(3)
    rows = table(spark, sf, "orders").select(
        "o_orderkey", priority().cast("double").alias("step"), F.floor(price / 50000).cast("double").alias("price"),
        label.alias("label"),
    )
    train, test = split(rows, 0.8, "o_orderkey", 11)
    inputs = ["step", "price"]
    _, copied, _ = train_and_score(
        oversample(train, "label", "o_orderkey", 12), test, severity_pipeline([], inputs, "label", 5)
    )
    weighed, scored, _ = train_and_score(
        class_weights(train, "label"), test, severity_pipeline([], inputs, "label", 5, weight="weight")
    )
    both = scored.join(copied.select("o_orderkey", F.col("prediction").alias("by_copies")), "o_orderkey")
    counts = both.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") != F.col("by_copies")).alias("n_different"),
        F.count_if(F.col("prediction") != F.col("label")).alias("n_wrong"),
    )
    return as_long(counts, "label")


def model_test_rows(spark, sf):
    """Scored test rows per actual severity of a shallow undersampled model, and
    how many of them got a severity that occurs."""
    _, out = prediction.fit_and_report(
        features(spark, sf), prediction.severity_model(max_depth=3), prediction.UNDERSAMPLED
    )
    known = F.when(F.col("predicted").isin(1, 2, 3), F.col("count")).otherwise(0)
    scored = out["confusion"].groupBy("actual").agg(F.sum("count").alias("n"), F.sum(known).alias("n_known"))
    return as_long(scored, "actual")


def rebalanced_training_rows(spark, sf):
    """Class sizes and distinct rows of the rebalanced training part."""
    rows = prediction.rebalanced_features(incidents(spark, sf), CUTOFF)
    train, _ = prediction.training_parts(rows, prediction.REBALANCED, rebalance=True)
    copies = count_by(train.select("Severity", "ID"), ["Severity", "ID"], "copies")
    sizes = copies.groupBy("Severity").agg(F.sum("copies").alias("n"), F.count("*").alias("n_ids"))
    return as_long(sizes, "Severity")


def model_save_load(spark, sf):
    """A model read back predicts every test row as before: rows and differences."""
    train, test = split(features(spark, sf), 0.8, "ID", 11)
    model, scored, _ = train_and_score(train, test, prediction.severity_model(max_depth=5))
    path = fresh_path(spark, "model")
    save_model(model, path)
    both = load_model(path).transform(scored.withColumnRenamed("prediction", "before"))
    return both.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("before") != F.col("prediction")).alias("n_different")
    )


def rule_predictions(spark, sf):
    """A fixed rule in place of a model: severity guessed from the price."""
    guess = F.least(F.lit(5), F.lit(1) + F.floor(F.col("o_totalprice") / 100000)).cast("double")
    return table(spark, sf, "orders").select(
        guess.alias("prediction"), priority().cast("double").alias("label")
    )


def accuracy_metric(spark, sf):
    return rounded(accuracy(rule_predictions(spark, sf), "prediction", "label"), 6, "accuracy")


def f1_metric(spark, sf):
    return rounded(weighted_f1(rule_predictions(spark, sf), "prediction", "label"), 6, "weighted_f1")


def confusion_counts(spark, sf):
    return as_long(confusion(rule_predictions(spark, sf), "prediction", "label"), "predicted", "actual")


QUERIES = {
    "learned_rule_predictions": learned_rule_predictions,
    "learned_rule_metrics": learned_rule_metrics,
    "ml_feature_table": ml_feature_table,
    "ml_feature_table_monday": ml_feature_table_monday,
    "string_index": string_index,
    "feature_vector": feature_vector,
    "model_predictions": model_predictions,
    "model_predictions_rebalanced": model_predictions_rebalanced,
    "model_metrics": model_metrics,
    "weights_against_copies": weights_against_copies,
    "model_test_rows": model_test_rows,
    "rebalanced_training_rows": rebalanced_training_rows,
    "model_save_load": model_save_load,
    "accuracy_metric": accuracy_metric,
    "f1_metric": f1_metric,
    "confusion_counts": confusion_counts,
}

_AIR = {"Temperature(F)": "temperature", "Pressure(in)": "pressure", "Humidity(%)": "humidity"}
_SEEN = {**_AIR, "Visibility(mi)": "visibility"}


def _features(measures: dict[str, str], rule: str, weekday: str) -> str:
    real = " AND ".join(f"{m} <> -999.0" for m in measures.values())
    numbers = ", ".join(
        f'{sql_round(c, 6)} AS "{name}"'
        for name, c in {"Start_Lat": "Start_Lat", "Start_Lng": "Start_Lng", **measures}.items()
    )
    return f"""
    features AS (
        SELECT ID, Severity, year(Start_Time) AS Year, month(Start_Time) AS Month,
               {weekday} AS Weekday, hour(Start_Time) AS Hour, {numbers},
               CAST(Junction AS BIGINT) AS Junction, CAST(Traffic_Signal AS BIGINT) AS Traffic_Signal
        FROM incidents WHERE {rule} AND {real})"""


_SUNDAY = _features(_SEEN, f"year(Start_Time) < {CUTOFF}", "dayofweek(Start_Time) + 1")
_MONDAY = _features(_AIR, f"year(Start_Time) <> {CUTOFF}", "isodow(Start_Time)")


def _vector() -> str:
    """Year, 12 month, 7 weekday and 23 hour places, then eight numbers: 51."""
    cells = ["Year"]
    cells += [f"CAST(Month = {i} AS INT)" for i in range(12)]
    cells += [f"CAST(Weekday = {i} AS INT)" for i in range(7)]
    cells += [f"CAST(Hour = {i} AS INT)" for i in range(23)]
    cells += ["Start_Lat", "Start_Lng", '"Temperature(F)"', '"Pressure(in)"', '"Humidity(%)"',
              '"Visibility(mi)"', "Junction", "Traffic_Signal"]
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, {sql_round(f'sum({c})', 3)} AS total FROM features"
        for i, c in enumerate(cells)
    )


def _picked(fractions: dict[int, float]) -> str:
    cases = " ".join(f"WHEN {level} THEN {part}" for level, part in fractions.items())
    return f"""
    picked AS (
        SELECT * FROM features WHERE {sql_hash('ID', 10)} < CASE Severity {cases} ELSE 0 END)"""


_RULE = f"""
    rule AS (
        SELECT least(5, 1 + CAST(floor(o_totalprice / 100000) AS BIGINT)) AS predicted,
               CAST({SQL_PRIORITY} AS BIGINT) AS actual
        FROM orders)"""

ORACLE = {
    "learned_rule_predictions": f"""
        SELECT o_orderkey, CAST({SQL_PRIORITY} * 7 % 4 AS BIGINT) AS prediction
        FROM orders WHERE {sql_hash('o_orderkey', 11)} >= 0.8""",
    "learned_rule_metrics": f"""
        SELECT DISTINCT CASE WHEN {sql_hash('o_orderkey', 11)} < 0.8 THEN 'train' ELSE 'test' END AS split,
               metric, 1.0::DOUBLE AS value
        FROM orders, (VALUES ('accuracy'), ('weighted_f1')) AS m(metric)""",
    "ml_feature_table": f"WITH {SQL_INCIDENTS}, {_SUNDAY} SELECT * FROM features",
    "ml_feature_table_monday": f"WITH {SQL_INCIDENTS}, {_MONDAY} SELECT * FROM features",
    "string_index": """
        SELECT o_orderpriority, n,
               CAST(row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS DOUBLE) AS position
        FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""",
    "feature_vector": f"WITH {SQL_INCIDENTS}, {_SUNDAY} {_vector()}",
    "weights_against_copies": f"""
        SELECT CAST(CASE WHEN o_totalprice < 300000 THEN 1 WHEN o_totalprice < 450000 THEN 2 ELSE 3 END AS BIGINT) AS label,
               count(*) AS n, 0::BIGINT AS n_different, 0::BIGINT AS n_wrong
        FROM orders WHERE {sql_hash('o_orderkey', 11)} >= 0.8 GROUP BY 1""",
    "model_test_rows": f"""
        WITH {SQL_INCIDENTS}, {_SUNDAY}, {_picked(prediction.UNDERSAMPLED)}
        SELECT Severity AS actual, count(*) AS n, count(*) AS n_known
        FROM picked WHERE {sql_hash('ID', 11)} >= 0.8 GROUP BY 1""",
    "rebalanced_training_rows": f"""
        WITH {SQL_INCIDENTS}, {_MONDAY}, {_picked(prediction.REBALANCED)},
        train AS (SELECT * FROM picked WHERE {sql_hash('ID', 11)} < 0.8),
        sizes AS (SELECT Severity, count(*) AS n FROM train GROUP BY 1),
        ratios AS (SELECT Severity, CAST(max(n) OVER () AS DOUBLE) / n AS ratio FROM sizes),
        copies AS (
            SELECT Severity, ID, CAST(floor(ratio) AS BIGINT)
                   + CASE WHEN {sql_hash('ID', 12)} < ratio - floor(ratio) THEN 1 ELSE 0 END AS n
            FROM train JOIN ratios USING (Severity))
        SELECT Severity, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT ID) AS n_ids FROM copies GROUP BY 1""",
    "model_save_load": f"""
        WITH {SQL_INCIDENTS}, {_SUNDAY}
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
        FROM features WHERE {sql_hash('ID', 11)} >= 0.8""",
    "accuracy_metric": f"""
        WITH {_RULE} SELECT {sql_round('avg(CAST(predicted = actual AS INT))', 6)} AS accuracy FROM rule""",
    "f1_metric": f"""
        WITH {_RULE},
        classes AS (SELECT predicted AS c FROM rule UNION SELECT actual FROM rule),
        per AS (
            SELECT c, (SELECT count(*) FROM rule WHERE actual = c) AS a,
                   (SELECT count(*) FROM rule WHERE predicted = c) AS p,
                   (SELECT count(*) FROM rule WHERE actual = c AND predicted = c) AS hit
            FROM classes)
        SELECT {sql_round('sum(2.0::DOUBLE * hit / (a + p) * a) / sum(a)', 6)} AS weighted_f1 FROM per""",
    "confusion_counts": f"WITH {_RULE} SELECT predicted, actual, count(*) AS count FROM rule GROUP BY 1, 2",
}
