"""Counts, averages and rankings (orders, lineitem)."""

from pyspark.sql import functions as F

from incidentry import (
    average_by,
    class_counts,
    count_by,
    keep_above,
    summarise,
    top_k,
    value_bounds,
)

from .common import SQL_PRIORITY, as_long, priority, rounded, sql_round, table


def two_key_counts(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", priority().alias("severity"))
    counts = count_by(orders, ["o_orderstatus", "severity"], "n")
    return as_long(counts, "severity").orderBy(F.desc("n"), "severity", "o_orderstatus")


def top_streets(spark, sf):
    counts = count_by(table(spark, sf, "lineitem").select("l_partkey"), ["l_partkey"], "n")
    return top_k(counts, "n", 10, ["l_partkey"])


def group_count_avg_top10(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", priority().alias("severity"))
    summary = summarise(orders, ["o_custkey"], "severity", 2, "n", "avg_severity")
    return top_k(summary, "n", 10, ["o_custkey"])


def top_avg_min_support(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", priority().alias("severity"))
    summary = summarise(orders, ["o_custkey"], "severity", count="n", average="avg_severity")
    worst = top_k(summary, "avg_severity", 10, ["o_custkey"], min_support=("n", 10))
    return rounded(worst, 3, "avg_severity")


def avg_by_severity(spark, sf):
    price = F.when(F.col("l_partkey") % 10 == 0, F.lit(-999.0)).otherwise(F.col("l_extendedprice"))
    lines = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("severity"), price.alias("price"))
    means = average_by(lines, ["severity"], "price", at_least=0.0, out="avg_price")
    return rounded(as_long(means, "severity"), 4, "avg_price")


def threshold_filter(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return keep_above(lines, {"l_quantity": 45.0, "l_extendedprice": 60000.0})


def order_value_bounds(spark, sf):
    counts = count_by(table(spark, sf, "orders").select("o_custkey"), ["o_custkey"], "n")
    return rounded(value_bounds(counts, "n"), 6, "lower_bound", "upper_bound")


def order_class_counts(spark, sf):
    orders = table(spark, sf, "orders").select(priority().alias("class"))
    return as_long(class_counts(orders, "class"), "class")


QUERIES = {
    "two_key_counts": two_key_counts,
    "top_streets": top_streets,
    "group_count_avg_top10": group_count_avg_top10,
    "top_avg_min_support": top_avg_min_support,
    "avg_by_severity": avg_by_severity,
    "threshold_filter": threshold_filter,
    "value_bounds": order_value_bounds,
    "class_counts": order_class_counts,
}

ORACLE = {
    "two_key_counts": f"""
        SELECT o_orderstatus, CAST({SQL_PRIORITY} AS BIGINT) AS severity, count(*) AS n
        FROM orders GROUP BY ALL""",
    "top_streets": """
        SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1
        ORDER BY n DESC, l_partkey LIMIT 10""",
    "group_count_avg_top10": f"""
        SELECT o_custkey, count(*) AS n, {sql_round(f'avg({SQL_PRIORITY})', 2)} AS avg_severity
        FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10""",
    "top_avg_min_support": f"""
        WITH per AS (
            SELECT o_custkey, count(*) AS n, avg({SQL_PRIORITY}) AS a
            FROM orders GROUP BY 1 HAVING count(*) > 10 ORDER BY a DESC, o_custkey LIMIT 10)
        SELECT o_custkey, n, {sql_round('a', 3)} AS avg_severity FROM per""",
    "avg_by_severity": f"""
        SELECT CAST(l_linenumber AS BIGINT) AS severity,
               {sql_round('avg(l_extendedprice)', 4)} AS avg_price
        FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1""",
    "threshold_filter": """
        SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
        WHERE l_quantity > 45 AND l_extendedprice > 60000""",
    "value_bounds": f"""
        SELECT {sql_round('min(n) * 0.9', 6)} AS lower_bound, {sql_round('max(n) * 1.1', 6)} AS upper_bound
        FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)""",
    "class_counts": f"""
        SELECT CAST({SQL_PRIORITY} AS BIGINT) AS class, count(*) AS count FROM orders GROUP BY 1""",
}
