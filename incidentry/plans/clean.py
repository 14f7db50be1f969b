"""From the raw CSV to a table without gaps."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..contract import MISSING_DEFAULTS, YEAR_PARTITION
from ..operators.cleaning import fill_defaults, null_report, strip_chars
from ..sources.rollups import YearlyRollups
from ..sources.versions import children
from ..sources.workspace import settings

# A task keeps the files of so many years open and sorts only rows of further ones; years that are
# put together stay apart, in tasks of their own.
_WRITING = {"spark.sql.maxConcurrentOutputFileWriters": "16", "spark.sql.unionOutputPartitioning": "false"}
_SMALL_FILE = 8 << 20
_FILE = 128 << 20


def clean_incidents(raw: DataFrame) -> DataFrame:
    """Fill the columns that have a default and strip backslashes from the text."""
    return strip_chars(fill_defaults(raw, MISSING_DEFAULTS), "Description")


def cleaning_reports(raw: DataFrame, cleaned: DataFrame) -> dict[str, DataFrame]:
    """Which columns miss values before and after cleaning."""
    return {"missingBefore": null_report(raw), "missingAfter": null_report(cleaned)}


def write_by_year(
    cleaned: DataFrame, path: str, ts: str = "Start_Time", compact: bool = True
) -> None:
    """Store the cleaned table as Parquet with one folder per year.

    Reports on a few years then open only those folders. Every task writes its
    own rows, into all years it has at once, so the table is neither shuffled nor
    sorted. Where that leaves a year in many small files, these are put together,
    so the number of files follows the size of the data, unless ``compact`` is false.
    """
    dated = cleaned.withColumn(YEAR_PARTITION, F.year(ts))
    with settings(cleaned.sparkSession, _WRITING):
        dated.write.mode("overwrite").partitionBy(YEAR_PARTITION).parquet(path)
        if compact:
            _put_together(cleaned.sparkSession, path, dated.schema)


def _put_together(spark: SparkSession, path: str, schema: StructType) -> None:
    """Write the years again that lie in several files of less than ``_SMALL_FILE`` on average.

    Tasks read whole files of one year, so nothing is shuffled. Spark writes beside
    the table and replaces a year's folder when all are written.
    """
    crowded = []
    for folder in children(spark, path):
        if folder.isDirectory() and folder.getPath().getName().startswith(f"{YEAR_PARTITION}="):
            at = folder.getPath().toString()
            sizes = [f.getLen() for f in children(spark, at) if not f.getPath().getName().startswith(("_", "."))]
            if len(sizes) > 1 and sum(sizes) < len(sizes) * _SMALL_FILE:
                rows = spark.read.schema(schema).option("basePath", path).parquet(at)
                crowded.append(rows.coalesce(math.ceil(sum(sizes) / _FILE)))
    if crowded:
        together = reduce(DataFrame.unionByName, crowded).write.mode("overwrite")
        together.option("partitionOverwriteMode", "dynamic").partitionBy(YEAR_PARTITION).parquet(path)


def year_partition(incidents: DataFrame) -> str | None:
    """The partition column of a table stored by ``write_by_year``."""
    return YEAR_PARTITION if YEAR_PARTITION in incidents.columns else None


def rolled_up(
    incidents: DataFrame, stage: Callable[[DataFrame, str], DataFrame], kept: YearlyRollups | None,
    build: Callable[[DataFrame], DataFrame], name: str, depends_on: object = (),
) -> DataFrame:
    """A roll-up of the table: kept by year where it is stored so, else made anew and staged."""
    return stage(build(incidents), name) if kept is None else kept.get(build, name, depends_on)
