"""Compare registered queries with their SQL: ``python -m checks.compare [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from . import all_oracles, all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _bag(frame) -> tuple[list, list]:
    """Sorted column names with types, and the sorted rows."""
    arrow = frame.select(sorted(frame.column_names))
    kinds = [f"{f.name}:{f.type}".replace("large_string", "string") for f in arrow.schema]
    rows = list(zip(*[c.to_pylist() for c in arrow.columns])) if arrow.num_rows else []
    return kinds, sorted(rows, key=repr)


def differences(df: DataFrame, con, sql: str) -> str | None:
    """What differs between a query's result and its SQL, or None."""
    got_kinds, got = _bag(df.toArrow())
    want_kinds, want = _bag(con.sql(sql).to_arrow_table())
    if got_kinds != want_kinds:
        return f"columns {got_kinds} but SQL {want_kinds}"
    if len(got) != len(want):
        return f"{len(got)} rows but SQL {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} but SQL {b}"
    return None


def main() -> None:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    names = sys.argv[1:] or list(all_queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in all_oracles():
                problem = differences(all_queries()[name](spark, sf_dir), con, all_oracles()[name])
            else:
                problem = None if all_queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in all_oracles() else "rows"
        print(f"{'BAD' if problem else 'ok '} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
