"""Roll-ups kept per year folder, so that only changed years are read again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .versions import children, exists
from .workspace import delete_folder


class YearlyRollups:
    """Roll-ups of a table that is stored with a folder per year.

    A roll-up is summed over each year folder on its own and kept under
    ``store``, beside a fingerprint of the folder (names, sizes and times of its
    files), of the session's time zone and of what the caller says it depends on.
    As long as the fingerprint holds, the folder is not opened again. The parts
    together are the roll-up: a key may occur in several, so what reads them has to
    sum, as all reports do.
    """

    def __init__(self, spark: SparkSession, table: str, store: str, partition: str = "start_year"):
        self.spark, self.partition = spark, partition
        self.table, self.store = table.rstrip("/"), store.rstrip("/")
        self.schema = spark.read.parquet(self.table).schema

    def folders(self) -> dict[str, str]:
        """Fingerprint of each year folder, by its name."""
        found = {}
        for status in children(self.spark, self.table):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(f"{self.partition}="):
                files = sorted(
                    (f.getPath().getName(), f.getLen(), f.getModificationTime())
                    for f in children(self.spark, f"{self.table}/{name}")
                )
                found[name] = hashlib.sha256(repr(files).encode()).hexdigest()[:24]
        return found

    def get(self, build: Callable[[DataFrame], DataFrame], name: str, depends_on: object = ()) -> DataFrame:
        """The roll-up that ``build`` makes of the table; ``depends_on`` tells its parameters."""
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        rule = hashlib.sha256(repr((zone, depends_on)).encode()).hexdigest()[:8]
        parts = []
        for folder, print_ in sorted(self.folders().items()):
            kept = f"{self.store}/{name}/{folder}"
            part = f"{kept}/{print_}-{rule}"
            if not exists(self.spark, f"{part}/_SUCCESS"):
                rows = self.spark.read.schema(self.schema).option("basePath", self.table).parquet(f"{self.table}/{folder}")
                build(rows).write.mode("overwrite").parquet(part)
                for status in children(self.spark, kept):  # earlier states of this folder
                    old = status.getPath().getName()
                    if old.endswith(f"-{rule}") and old != f"{print_}-{rule}":
                        delete_folder(self.spark, f"{kept}/{old}")
            parts.append(part)
        empty = build(self.spark.createDataFrame([], self.schema))
        if not parts:
            return empty
        return self.spark.read.schema(empty.schema).parquet(*parts)
