"""Intermediate tables in the folder all executors share.

A staged table cuts the lineage, survives lost executors and has a known size
on disk, so Spark's own broadcast threshold decides how it is joined.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_made: list[str] = []
_path_of: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def workspace(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session (as in tests) gets a new
    temporary folder; a cluster session is refused, because executors would not
    see the driver's disk.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="incidentry-")
    spark.conf.set(_SETTING, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the workspace that nothing has used yet."""
    path = f"{workspace(spark)}/incidentry/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """The session has these settings within, and its own afterwards."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was staged within: a job's results are stored by then."""
    before = len(_made)
    try:
        yield
    finally:
        while len(_made) > before:
            delete_folder(spark, _made.pop())


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the workspace as Parquet and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _path_of[staged] = path
    return staged


def stage_alone(build: Callable[[], DataFrame], label: str, always: bool = False) -> DataFrame:
    """What ``build`` makes, written down; everything that was staged on the way is deleted then.

    A frame for which nothing was staged is returned as it is, unless it shall ``always`` be written.
    """
    before = set(_made)
    df = build()
    on_the_way = [path for path in _made if path not in before]
    if not on_the_way and not always:
        return df
    out = stage(df, label)
    for path in on_the_way:
        delete_folder(df.sparkSession, path)
        _made.remove(path)
    return out


def discard(staged: DataFrame) -> None:
    """Delete the table that ``stage`` wrote for this frame, which nothing reads again."""
    path = _path_of.pop(staged)
    delete_folder(staged.sparkSession, path)
    if path in _made:
        _made.remove(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
