"""Shared by the check modules: table access and SQL snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(*names: str) -> list[Column]:
    """Calendar fields and counts as bigint, the type SQL returns."""
    return [F.col(n).cast("bigint").alias(n) for n in names]


def as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def sql_round(expression: str, digits: int) -> str:
    """Decimal rounding, half up, as Spark rounds doubles."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def priority() -> Column:
    """The ordinal 1-5 that leads the order priority."""
    return F.substring("o_orderpriority", 1, 1).cast("int")


SQL_PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"


def sql_hash(key: str, seed: int) -> str:
    text = f"'{seed}|' || CAST({key} AS VARCHAR)"
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
