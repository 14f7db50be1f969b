"""Severity classifiers on MLlib, and their evaluation as plain aggregations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..sources.workspace import settings, stage
from .cleaning import drop_sentinels
from .sampling import union_all

# Training rows are stored in groups of this size, so tasks can be made of equally many.
_GROUP = str(4 << 20)
_GROUPED = {"parquet.block.size": _GROUP}
_BY_GROUP = {"spark.sql.files.maxPartitionBytes": _GROUP}


def feature_table(
    df: DataFrame,
    ts: str,
    label: str,
    measures: Sequence[str],
    flags: Sequence[str] = (),
    keep: Sequence[str] = (),
    sentinels: Mapping[str, object] | None = None,
    weekday: str = "sunday",
) -> DataFrame:
    """Label, calendar parts, measures and 0/1 flags, without sentinel rows.

    ``weekday`` picks the numbering: ``"sunday"`` or ``"monday"`` is day 1.
    """
    t = F.col(ts)
    day = F.dayofweek(t) if weekday == "sunday" else F.weekday(t) + F.lit(1)
    known = drop_sentinels(df, sentinels) if sentinels else df
    return known.select(
        *keep,
        F.col(label),
        F.year(t).alias("Year"),
        F.month(t).alias("Month"),
        day.alias("Weekday"),
        F.hour(t).alias("Hour"),
        *measures,
        *[F.col(f).cast("int").alias(f) for f in flags],
    )


def severity_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    max_depth: int = 15,
    indexed: Sequence[str] = (),
    handle_invalid: str = "error",
    order: Sequence[str] | None = None,
    weight: str | None = None,
) -> Pipeline:
    """Index, one-hot encode, assemble and classify, all in one pipeline.

    ``indexed`` columns are string-indexed (most frequent first) and then
    one-hot encoded; ``categorical`` columns are encoded as they are.
    ``order`` lists the inputs in the order the vector should have, ``weight``
    names the column that says how much a training row counts.
    """
    to_index = {c: f"{c}_index" for c in indexed}
    encoded = {c: f"{c}_vec" for c in [*categorical, *indexed]}
    stages: list = []
    if to_index:
        stages.append(
            StringIndexer(
                inputCols=list(to_index), outputCols=list(to_index.values()),
                handleInvalid=handle_invalid,
            )
        )
    if encoded:
        stages.append(
            OneHotEncoder(
                inputCols=[to_index.get(c, c) for c in encoded],
                outputCols=list(encoded.values()), handleInvalid=handle_invalid,
            )
        )
    inputs = [encoded.get(c, c) for c in (order or [*categorical, *numeric, *indexed])]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid=handle_invalid))
    tree = DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=max_depth)
    stages.append(tree.setWeightCol(weight) if weight else tree)
    return Pipeline(stages=stages)


def confusion(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Rows per predicted and actual class: every "actual per predicted" report in one."""
    return df.groupBy(
        F.col(pred).cast("int").alias("predicted"), F.col(label).cast("int").alias("actual")
    ).agg(F.count("*").alias("count"))


def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    """One row: the part of the rows predicted right."""
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def weighted_f1(df: DataFrame, pred: str, label: str) -> DataFrame:
    """One row: F1 per class, weighted by the class's actual size."""
    return scores(confusion(df, pred, label)).select("weighted_f1")


def scores(matrix: DataFrame) -> DataFrame:
    """One row with accuracy and weighted F1 of a confusion matrix."""
    n, right = F.col("count"), F.col("predicted") == F.col("actual")
    none = F.lit(0).cast("bigint")
    sides = matrix.select(
        F.inline(F.array(
            F.struct(F.col("actual").alias("class"), n.alias("actual_rows"),
                     none.alias("predicted_rows"), F.when(right, n).otherwise(none).alias("hits")),
            F.struct(F.col("predicted").alias("class"), none.alias("actual_rows"),
                     n.alias("predicted_rows"), none.alias("hits")),
        ))
    )
    per_class = sides.groupBy("class").agg(
        F.sum("actual_rows").alias("actual_rows"),
        F.sum("predicted_rows").alias("predicted_rows"),
        F.sum("hits").alias("hits"),
    )
    f1 = F.lit(2.0) * F.col("hits") / (F.col("actual_rows") + F.col("predicted_rows"))
    return per_class.agg(
        ratio(F.sum("hits"), F.sum("actual_rows")).alias("accuracy"),
        ratio(F.sum(f1 * F.col("actual_rows")), F.sum("actual_rows")).alias("weighted_f1"),
    )


def train_and_score(
    train: DataFrame, test: DataFrame, pipeline: Pipeline
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on one frame and score both.

    Returns the model, the test rows with their ``prediction``, and a
    ``(split, metric, value)`` frame of accuracy and weighted F1. Fitting reads
    the training rows many times and the scored rows feed several reports, so
    both are staged. Every level of the tree is a pass with a task for each part of
    the training rows, so these are dealt out evenly over all cores.
    """
    label = pipeline.getStages()[-1].getLabelCol()
    spark = train.sparkSession
    with settings(spark, _GROUPED):
        train = stage(train, "train")
    even = train.coalesce(_even_tasks(train))
    with settings(spark, _BY_GROUP):
        model = pipeline.fit(even)
    scored = stage(model.transform(test).select(*test.columns, "prediction"), "scored")
    metrics = union_all([
        _metrics(confusion(model.transform(train), "prediction", label), "train"),
        _metrics(confusion(scored, "prediction", label), "test"),
    ])
    return model, scored, metrics


def _even_tasks(df: DataFrame) -> int:
    """As many tasks as a scan has, and so many more that every core gets as many."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return math.ceil(max(df.rdd.getNumPartitions(), 1) / cores) * cores


def _metrics(matrix: DataFrame, split: str) -> DataFrame:
    wide = scores(matrix).select(F.lit(split).alias("split"), "accuracy", "weighted_f1")
    return wide.unpivot(["split"], ["accuracy", "weighted_f1"], "metric", "value")


def predictions(scored: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    """The prediction table for maps: kept columns, actual and predicted class."""
    return scored.select(*keep, label, F.col("prediction").cast("int").alias(f"{label}_pr"))
