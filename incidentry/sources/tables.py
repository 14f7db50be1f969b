"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .versions import current_version, new_version, publish
from .workspace import stage

# Quotes inside quoted text are doubled, as spreadsheets and most writers do.
_CSV_STYLE = {"quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    header: bool = True,
    **options,
) -> DataFrame:
    """Scan CSV. Columns bind to ``schema`` by position; without one all are text.

    CSV cannot tell empty text from missing text: both are read as null.
    """
    reader = spark.read.options(**{**_CSV_STYLE, "header": header, **options})
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_table(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """Scan any stored table; stores addressed by options alone need no path."""
    return spark.read.format(fmt).options(**options).load(path)


def _place(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def save_result(
    df: DataFrame,
    root: str | None,
    name: str,
    fmt: str = "parquet",
    single_file: bool = False,
    **options,
) -> None:
    """Overwrite the named result. While it is written there is none; see ``replace_result``.

    ``single_file`` asks Spark to even out the output: a chart-sized result
    becomes one file, while a large one still is written by many tasks. With
    ``root=None`` the store is addressed by the options alone.
    """
    if single_file:
        df = df.hint("rebalance")
    if fmt == "csv":
        options = {**_CSV_STYLE, "header": True, **options}
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    writer.save(_place(root, name) if root is not None else None)


def replace_result(
    df: DataFrame,
    root: str | None,
    name: str,
    fmt: str = "parquet",
    single_file: bool = False,
    kept: int = 2,
    **options,
) -> None:
    """Replace the named result: ``load_result`` reads the old one until the new one is complete.

    A failed write leaves the old one in place. The ``kept`` newest versions
    stay, for readers that have begun. Stores without a path replace in their own way.
    """
    if root is None:
        return save_result(df, root, name, fmt, single_file, **options)
    place = _place(root, name)
    version = new_version(place)
    save_result(df, *version.rsplit("/", 1), fmt, single_file, **options)
    publish(df.sparkSession, place, version, kept)


def load_result(
    spark: SparkSession, root: str | None, name: str, fmt: str = "parquet", **options
) -> DataFrame:
    """Read a named result back, its newest version if it has several, without the row id some stores add."""
    if fmt == "csv":
        options = {**_CSV_STYLE, "header": True, **options}
    path = _place(root, name) if root is not None else None
    if path is not None:
        path = current_version(spark, path) or path
    return read_table(spark, path, fmt, **options).drop("_id")


def run_outputs(
    df: DataFrame,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    root: str | None,
    fmt: str = "parquet",
    reuse: str = "stage",
    single_file: bool = True,
    **options,
) -> None:
    """Compute several named results of one derived frame.

    ``df`` should already be projected and filtered. ``reuse`` says how the
    results share it: ``"stage"`` writes it once to the shared workspace (the
    choice for large data: columns stay prunable and lost executors cost
    nothing), ``"persist"`` keeps it on the executors, ``"none"`` recomputes it.
    """
    if reuse not in ("stage", "persist", "none"):
        raise ValueError(f"reuse must be stage, persist or none, not {reuse!r}")
    if reuse == "stage":
        shared = stage(df, "shared")
    else:
        shared = df.persist(StorageLevel.MEMORY_AND_DISK) if reuse == "persist" else df
    try:
        for name, build in outputs.items():
            save_result(build(shared), root, name, fmt, single_file, **options)
    finally:
        if reuse == "persist":
            shared.unpersist()
