"""Calendar parts and counts over time (orders, events)."""

from pyspark.sql import functions as F

from incidentry import (
    average_and_max,
    baseline,
    calendar_parts,
    count_by,
    distinct_values,
    in_years,
    not_year,
    parse_timestamp,
    preview,
)

from .common import SQL_PRIORITY, as_long, big, priority, rounded, sql_round, table

YEARS = (1996, 1997, 1998)
LAST_YEAR = 2000


def month_counts(spark, sf):
    orders = in_years(table(spark, sf, "orders"), "o_orderdate", YEARS)
    counts = count_by(orders.select(F.month("o_orderdate").alias("month")), ["month"], "n")
    return as_long(counts, "month").orderBy("month")


def weekday_counts(spark, sf):
    orders = in_years(table(spark, sf, "orders"), "o_orderdate", YEARS)
    counts = count_by(orders.select(F.dayofweek("o_orderdate").alias("weekday")), ["weekday"], "n")
    return as_long(counts, "weekday").orderBy("weekday")


def hour_counts(spark, sf):
    events = table(spark, sf, "events").select(F.hour("ts").alias("hour"))
    return as_long(count_by(events, ["hour"], "n"), "hour").orderBy("hour")


def year_counts(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return as_long(count_by(orders, ["year"], "n"), "year").orderBy("year")


def all_calendar_parts(spark, sf):
    parts = calendar_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    return parts.select(
        "o_orderkey",
        F.col("date").cast("string").alias("date"),
        *big("year", "month", "day", "hour", "weekday_sunday1", "weekday_monday1"),
    )


def event_calendar_parts(spark, sf):
    parts = calendar_parts(table(spark, sf, "events").select("event_id", "ts"), "ts")
    return parts.select("event_id", *big("day", "hour", "weekday_sunday1", "weekday_monday1"))


def parsed_timestamps(spark, sf):
    stamp = F.date_trunc("second", "ts").cast("string")
    text = F.when(F.col("event_id") % 9 == 0, F.lit("not a time")).otherwise(stamp)
    events = table(spark, sf, "events").select("event_id", text.alias("text"))
    parsed = parse_timestamp(events, "text", "parsed")
    return parsed.select(
        "event_id", F.coalesce(F.col("parsed").cast("string"), F.lit("unreadable")).alias("parsed")
    )


def baseline_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", priority().alias("severity"))
    kept = baseline(orders, "o_orderdate", "severity", LAST_YEAR)
    return as_long(kept.select("o_orderkey", "severity"), "severity")


def year_exclude_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return not_year(orders, "o_orderdate", LAST_YEAR).select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("year")
    )


def year_avg_max(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    return as_long(average_and_max(orders, ["year"], "o_totalprice"), "year").orderBy("year")


def preview_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return preview(orders, ["o_orderkey"], 20)


def distinct_statuses(spark, sf):
    return distinct_values(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


QUERIES = {
    "month_counts": month_counts,
    "weekday_counts": weekday_counts,
    "hour_counts": hour_counts,
    "year_counts": year_counts,
    "calendar_parts": all_calendar_parts,
    "calendar_parts_hours": event_calendar_parts,
    "parse_timestamp": parsed_timestamps,
    "baseline_filter": baseline_filter,
    "year_exclude_filter": year_exclude_filter,
    "year_avg_max": year_avg_max,
    "preview_rows": preview_rows,
    "distinct_values": distinct_statuses,
}

ORACLE = {
    "month_counts": """
        SELECT month(o_orderdate) AS month, count(*) AS n FROM orders
        WHERE year(o_orderdate) IN (1996, 1997, 1998) GROUP BY 1""",
    "weekday_counts": """
        SELECT dayofweek(o_orderdate) + 1 AS weekday, count(*) AS n FROM orders
        WHERE year(o_orderdate) IN (1996, 1997, 1998) GROUP BY 1""",
    "hour_counts": "SELECT hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1",
    "year_counts": "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1",
    "calendar_parts": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date,
               year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
               hour(o_orderdate) AS hour, dayofweek(o_orderdate) + 1 AS weekday_sunday1,
               isodow(o_orderdate) AS weekday_monday1
        FROM orders""",
    "calendar_parts_hours": """
        SELECT event_id, day(ts) AS day, hour(ts) AS hour, dayofweek(ts) + 1 AS weekday_sunday1,
               isodow(ts) AS weekday_monday1
        FROM events""",
    "parse_timestamp": """
        WITH texts AS (
            SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'not a time'
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS text
            FROM events)
        SELECT event_id,
               coalesce(strftime(TRY_CAST(text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), 'unreadable') AS parsed
        FROM texts""",
    "baseline_filter": f"""
        SELECT o_orderkey, CAST({SQL_PRIORITY} - 1 AS BIGINT) AS severity FROM orders
        WHERE year(o_orderdate) < 2000""",
    "year_exclude_filter": """
        SELECT o_orderkey, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) <> 2000""",
    "year_avg_max": f"""
        SELECT year(o_orderdate) AS year, {sql_round('avg(o_totalprice)', 1)} AS avg_o_totalprice,
               max(o_totalprice) AS max_o_totalprice
        FROM orders GROUP BY 1""",
    "preview_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20""",
    "distinct_values": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
}
