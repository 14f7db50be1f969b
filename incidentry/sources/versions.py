"""Which version of a stored result is the current one.

A version is a folder of its own beside the earlier ones. Once it is complete, a
small note with the next number is added that names it; readers take the
note with the highest number. Nothing is overwritten or renamed, so a reader
finds the earlier version until the new one stands, on object stores too.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_NOTES = "_published"


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list:
    """Status of the files and folders in a folder; none where it does not exist."""
    place, files = _at(spark, path)
    return list(files.listStatus(place)) if files.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def new_version(place: str) -> str:
    return f"{place}/version-{uuid.uuid4().hex}"


def _notes(spark: SparkSession, place: str) -> dict[int, str]:
    """Path of the version that each note names; a note that is still being written is none."""
    found = {}
    for status in children(spark, f"{place}/{_NOTES}"):
        number = status.getPath().getName()
        if number.isdigit():
            stream = status.getPath().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(status.getPath())
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                found[int(number)] = f"{place}/{text.strip()}"
    return found


def current_version(spark: SparkSession, place: str) -> str | None:
    """Folder of the newest complete version, if any was published here."""
    notes = _notes(spark, place)
    return notes[max(notes)] if notes else None


def publish(spark: SparkSession, place: str, version: str, kept: int) -> None:
    """Make a complete version the current one, and remove all but the ``kept`` newest.

    Earlier ones stay for jobs that read them now. Of two writers at once the later note wins.
    """
    notes = _notes(spark, place)
    number = max(notes, default=0) + 1
    while True:
        note, files = _at(spark, f"{place}/{_NOTES}/{number:010d}")
        try:
            stream = files.create(note, False)
            break
        except Py4JJavaError as error:
            if not files.exists(note):
                raise error
            number += 1  # taken by another writer
    stream.write(f"{version.rsplit('/', 1)[1]}\n".encode())
    stream.close()
    notes = _notes(spark, place)
    for old in sorted(notes)[:-kept]:
        folder, files = _at(spark, notes[old])
        files.delete(folder, True)
        note, files = _at(spark, f"{place}/{_NOTES}/{old:010d}")
        files.delete(note, False)
