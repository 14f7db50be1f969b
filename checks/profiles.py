"""Shares, pivots, distributions and map cells."""

from pyspark.sql import functions as F

from incidentry import (
    count_by,
    density_curve,
    distribution,
    geo_grid,
    histogram,
    pivot_counts,
    series,
    share,
)

from .common import SQL_PRIORITY, as_long, priority, rounded, sql_round, table


def share_of_total(spark, sf):
    counts = count_by(table(spark, sf, "orders").select("o_orderpriority"), ["o_orderpriority"], "n")
    return share(counts, "n", digits=6)


def share_within_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    counts = count_by(orders, ["o_orderstatus", "o_orderpriority"], "n")
    return share(counts, "n", ["o_orderstatus"], digits=6)


def category_pivot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus")
    return pivot_counts(
        orders, ["o_orderpriority"], "o_orderstatus", {"F": "n_f", "O": "n_o", "P": "n_p"}
    )


def side_series(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", priority().alias("severity"))
    counts = count_by(orders, ["o_orderstatus", "severity"], "n")
    return as_long(series(counts, "o_orderstatus", "F", ["severity"]), "severity")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _summary(spark, sf, key):
    lines = table(spark, sf, "lineitem").select(key.alias("severity"), *MEASURES)
    summary = distribution(lines, "severity", MEASURES)
    return rounded(
        as_long(summary, "severity"), 6, "min", "p25", "p50", "p75", "max", "mean", "stddev"
    )


def distribution_summary(spark, sf):
    return _summary(spark, sf, F.col("l_linenumber"))


def distribution_summary_large(spark, sf):
    """Two groups, of half of the rows each."""
    return _summary(spark, sf, F.col("l_linenumber") % 2)


CURVES = ["l_quantity", "l_extendedprice", "l_discount"]


def density_curves(spark, sf):
    """Outlines of violins; the density is given per bandwidth, so that all measures are of one size."""
    lines = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("severity"), *CURVES)
    curves = density_curve(lines, "severity", CURVES).withColumn("density", F.col("density") * F.col("bandwidth"))
    # twelve digits first, as the SQL's decimals have
    curves = rounded(rounded(as_long(curves, "severity", "point"), 6, "value", "bandwidth"), 12, "density")
    return rounded(curves, 9, "density")


def distribution_histogram(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("severity"), "l_extendedprice")
    return as_long(histogram(lines, ["severity"], "l_extendedprice", 0.0, 5000.0, out="n"), "severity")


def geo_grid_counts(spark, sf):
    events = table(spark, sf, "events").select(
        (F.col("value") - 180).alias("lon"), (F.col("value") / 10).alias("lat"), "event_type"
    )
    return geo_grid(events, "lat", "lon", 2.5, ["event_type"], "n")


QUERIES = {
    "share_of_total": share_of_total,
    "share_within_group": share_within_group,
    "category_pivot": category_pivot,
    "side_series": side_series,
    "distribution_summary": distribution_summary,
    "distribution_summary_large": distribution_summary_large,
    "density_curve": density_curves,
    "distribution_histogram": distribution_histogram,
    "geo_grid_counts": geo_grid_counts,
}


def _measure_sql(m: str, key: str) -> str:
    parts = {
        "min": f"min({m})",
        "p25": f"quantile_cont({m}, 0.25)",
        "p50": f"quantile_cont({m}, 0.5)",
        "p75": f"quantile_cont({m}, 0.75)",
        "max": f"max({m})",
        "mean": f"avg({m})",
        "stddev": f"stddev_samp({m})",
    }
    columns = ", ".join(f"{sql_round(e, 6)} AS {name}" for name, e in parts.items())
    return f"""
        SELECT CAST({key} AS BIGINT) AS severity, '{m}' AS measure, count({m}) AS n, {columns}
        FROM lineitem GROUP BY 1"""


def _distribution(key: str) -> str:
    return " UNION ALL ".join(_measure_sql(m, key) for m in MEASURES)


def sql_density(source: str, key: str, column: str, measure: str) -> str:
    """The kernel summed over all values, at each of 100 points."""
    return f"""
        SELECT severity, '{measure}' AS measure, CAST(point AS BIGINT) AS point,
               {sql_round('value', 6)} AS value, {sql_round('h', 6)} AS bandwidth,
               CASE WHEN h > 0 THEN {sql_round("(SELECT sum(exp(-0.5::DOUBLE * pow((value - x) / nullif(h, 0), 2))) FROM (SELECT " + key
                          + " AS k, " + column + " AS x FROM " + source + ") AS v WHERE k = severity) / (n * sqrt(2 * pi()))", 9)}
               END AS density
        FROM (
            SELECT severity, n, h, point, lo - 2 * h + point * (hi - lo + 4 * h) / 99.0::DOUBLE AS value
            FROM (
                SELECT {key} AS severity, count({column}) AS n, min({column}) AS lo, max({column}) AS hi,
                       greatest((hi - lo) / 100.0::DOUBLE, 1.059::DOUBLE * pow(n, -0.2::DOUBLE) * least(
                           stddev_samp({column}),
                           (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) / 1.349::DOUBLE)) AS h
                FROM {source} GROUP BY 1),
            unnest(range(CASE WHEN h > 0 THEN 100 ELSE 1 END)) AS t(point))"""


ORACLE = {
    "density_curve": " UNION ALL ".join(sql_density("lineitem", "CAST(l_linenumber AS BIGINT)", m, m) for m in CURVES),
    "share_of_total": f"""
        SELECT o_orderpriority, n, {sql_round('CAST(n AS DOUBLE) / sum(n) OVER ()', 6)} AS share
        FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""",
    "share_within_group": f"""
        SELECT o_orderstatus, o_orderpriority, n,
               {sql_round('CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY o_orderstatus)', 6)} AS share
        FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)""",
    "category_pivot": """
        SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_f,
               count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p
        FROM orders GROUP BY 1""",
    "side_series": f"""
        SELECT o_orderstatus, CAST({SQL_PRIORITY} AS BIGINT) AS severity, count(*) AS n
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2""",
    "distribution_summary": _distribution("l_linenumber"),
    "distribution_summary_large": _distribution("l_linenumber % 2"),
    "distribution_histogram": """
        SELECT CAST(l_linenumber AS BIGINT) AS severity,
               CAST(floor(l_extendedprice / 5000.0::DOUBLE) AS BIGINT) AS bin, count(*) AS n
        FROM lineitem GROUP BY 1, 2""",
    "geo_grid_counts": """
        SELECT event_type, CAST(floor(value / 10 / 2.5::DOUBLE) AS BIGINT) AS lat_cell,
               CAST(floor((value - 180) / 2.5::DOUBLE) AS BIGINT) AS lon_cell, count(*) AS n
        FROM events GROUP BY 1, 2, 3""",
}
