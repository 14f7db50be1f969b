"""Scans, sinks, projections and shared frames.

Each run writes to a new folder of the workspace and reads it back.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from incidentry import (
    count_by,
    load_result,
    read_csv,
    read_table,
    run_outputs,
    save_result,
    union_all,
)
from incidentry.contract import YEAR_PARTITION
from incidentry.sources.workspace import fresh_path

from .common import table
from .incidents import SQL_INCIDENTS, store

_CSV_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _dated(df):
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def csv_roundtrip(spark, sf):
    orders = table(spark, sf, "orders").select(*_CSV_COLUMNS)
    root = fresh_path(spark, "csv")
    save_result(orders, root, "orders", "csv")
    return _dated(read_csv(spark, f"{root}/orders", orders.schema))


def csv_headerless_scan(spark, sf):
    orders = table(spark, sf, "orders").select(*_CSV_COLUMNS)
    root = fresh_path(spark, "csv")
    save_result(orders, root, "orders", "csv", header=False)
    return _dated(read_csv(spark, f"{root}/orders", orders.schema, header=False))


def csv_string_scan(spark, sf):
    root = fresh_path(spark, "csv")
    save_result(table(spark, sf, "customer"), root, "customer", "csv", single_file=True)
    return read_csv(spark, f"{root}/customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def csv_dimension_scan(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("state"))
    root = fresh_path(spark, "csv")
    save_result(count_by(customers, ["state"], "pop"), root, "population", "csv", single_file=True)
    two_columns = StructType().add("state", StringType()).add("pop", LongType())
    return read_csv(spark, f"{root}/population", two_columns)


def json_inferred_scan(spark, sf):
    root = fresh_path(spark, "json")
    save_result(table(spark, sf, "supplier"), root, "supplier", "json")
    return read_table(spark, f"{root}/supplier", "json").select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal"
    )


def result_roundtrip(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    counts = count_by(orders, ["o_orderstatus", "o_orderpriority"], "n")
    root = fresh_path(spark, "results")
    for _ in range(2):  # the second write replaces the first
        save_result(counts.withColumn("_id", F.expr("uuid()")), root, "counts", single_file=True)
    return load_result(spark, root, "counts")


def multi_output_job(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("string").alias("year")
    )
    keys = {"by_status": "o_orderstatus", "by_priority": "o_orderpriority", "by_year": "year"}
    root = fresh_path(spark, "results")
    run_outputs(
        orders, {name: lambda df, k=k: count_by(df, [k], "n") for name, k in keys.items()}, root
    )
    return union_all([
        load_result(spark, root, name).select(
            F.lit(name).alias("report"), F.col(k).alias("value"), "n"
        )
        for name, k in keys.items()
    ])


def store_by_year(spark, sf):
    """The cleaned incidents written by year; rows, years and stripped text read back."""
    stored = store(spark, sf).select(F.col(YEAR_PARTITION).cast("bigint").alias("year"), "Description")
    return stored.groupBy("year").agg(
        F.count("*").alias("n"), F.count_if(F.col("Description").contains("\\")).alias("n_slashed")
    )


def project_columns(spark, sf):
    columns = ["l_orderkey", "l_quantity", "l_shipdate"]
    lines = table(spark, sf, "lineitem").select(*columns)
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def drop_columns(spark, sf):
    customers = table(spark, sf, "customer").drop("c_name", "c_acctbal")
    return customers.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


QUERIES = {
    "store_by_year": store_by_year,
    "csv_roundtrip": csv_roundtrip,
    "csv_headerless_scan": csv_headerless_scan,
    "csv_string_scan": csv_string_scan,
    "csv_dimension_scan": csv_dimension_scan,
    "json_inferred_scan": json_inferred_scan,
    "result_roundtrip": result_roundtrip,
    "multi_output_job": multi_output_job,
    "project_columns": project_columns,
    "drop_columns": drop_columns,
}

_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
    FROM orders"""

ORACLE = {
    "store_by_year": f"""
        WITH {SQL_INCIDENTS}
        SELECT year(Start_Time) AS year, count(*) AS n, CAST(0 AS BIGINT) AS n_slashed
        FROM incidents GROUP BY 1""",
    "csv_roundtrip": _ORDERS,
    "csv_headerless_scan": _ORDERS,
    "csv_string_scan": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
        FROM customer""",
    "csv_dimension_scan": """
        SELECT CAST(c_nationkey AS VARCHAR) AS state, count(*) AS pop FROM customer GROUP BY 1""",
    "json_inferred_scan": """
        SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier""",
    "result_roundtrip": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""",
    "multi_output_job": """
        SELECT 'by_status' AS report, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
        UNION ALL SELECT 'by_priority', o_orderpriority, count(*) FROM orders GROUP BY 2
        UNION ALL SELECT 'by_year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2""",
    "project_columns": """
        SELECT l_orderkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
        FROM lineitem""",
    "drop_columns": """
        SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer""",
}
