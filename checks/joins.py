"""Rankings joined back, cohorts, and rates by dimension."""

from pyspark.sql import functions as F

from incidentry import (
    attach_attribute,
    cohort_compare,
    count_by,
    rate_by_dimension,
    summarise,
    top_group_peaks,
    top_k,
    two_level_rate,
)

from .common import SQL_PRIORITY, as_long, priority, sql_round, table


def _daily_orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_custkey").alias("city"), "o_orderstatus"
    )


def _day_text(df):
    return df.withColumn("day", F.col("day").cast("string"))


def top_group_peak_days(spark, sf):
    return _day_text(top_group_peaks(_daily_orders(spark, sf), "city", "day", 10, 12))


def peak_day_attributes(spark, sf):
    orders = _daily_orders(spark, sf)
    peaks = top_group_peaks(orders, "city", "day", 10, 12)
    return _day_text(attach_attribute(peaks, orders, ["day", "city"], ["o_orderstatus"]))


def peak_day_drilldown(spark, sf):
    """Order states of the busiest day and customer, which are read first."""
    worst = top_group_peaks(_daily_orders(spark, sf), "city", "day", 10, 1).first()
    orders = table(spark, sf, "orders").filter(
        (F.to_date("o_orderdate") == F.lit(str(worst["day"])).cast("date"))
        & (F.col("o_custkey") == worst["city"])
    )
    return count_by(orders, ["o_orderstatus"], "n").orderBy(F.desc("n"), "o_orderstatus")


def orders_per_nation(spark, sf, *extra):
    """Order counts per nation. Orders are counted per customer first, so a
    customer with very many orders reaches the join as one row."""
    orders = table(spark, sf, "orders").select("o_custkey", *extra)
    per_customer = count_by(orders, orders.columns, "orders")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def population(spark, sf):
    """Customers per nation."""
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("state"))
    return count_by(customers, ["state"], "pop")


def timezone_summary(spark, sf):
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    orders = orders_per_nation(spark, sf, priority().alias("severity"))
    placed = orders.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    summary = summarise(placed, ["r_name"], "severity", 3, "n", "avg_severity", weight="orders")
    return top_k(summary, "n", 10, ["r_name"])


def state_rate(spark, sf):
    orders = orders_per_nation(spark, sf)
    counts = count_by(orders, ["c_nationkey"], "n", weight="orders")
    top = top_k(counts, "n", 10, ["c_nationkey"])
    rates = rate_by_dimension(top, population(spark, sf), ("c_nationkey", "state"), "n", "pop", digits=6)
    return as_long(rates, "c_nationkey")


def colour_rate(spark, sf):
    colour = F.when(F.col("n_regionkey") % 2 == 0, "red").otherwise("blue")
    election = table(spark, sf, "nation").select(F.col("n_nationkey").alias("state"), colour.alias("color"))
    orders = orders_per_nation(spark, sf)
    return two_level_rate(
        orders, "c_nationkey", population(spark, sf), election, "state", "color", "pop", 6, "orders"
    )


def cohort_month_compare(spark, sf):
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select(
        F.month("o_orderdate").alias("month"), "o_totalprice"
    )
    cohorts = {
        "count_north": F.col("o_totalprice") > 400000,
        "count_south": F.col("o_totalprice") < 100000,
    }
    return as_long(cohort_compare(orders, "month", cohorts), "month").orderBy("month")


QUERIES = {
    "top_group_peak_days": top_group_peak_days,
    "peak_day_attributes": peak_day_attributes,
    "peak_day_drilldown": peak_day_drilldown,
    "timezone_summary": timezone_summary,
    "rate_by_dimension": state_rate,
    "two_level_rate": colour_rate,
    "cohort_month_compare": cohort_month_compare,
}

_PEAKS = """
    daily AS (
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey AS city, count(*) AS count
        FROM orders GROUP BY 1, 2),
    leaders AS (
        SELECT city, sum(count) AS n FROM daily GROUP BY 1 ORDER BY n DESC, city LIMIT 10),
    peaks AS (
        SELECT daily.* FROM daily JOIN leaders USING (city) ORDER BY count DESC, day, city LIMIT 12)"""

ORACLE = {
    "top_group_peak_days": f"WITH {_PEAKS} SELECT day, city, count FROM peaks",
    "peak_day_attributes": f"""
        WITH {_PEAKS}
        SELECT p.day, p.city, p.count, o.o_orderstatus
        FROM orders o JOIN peaks p
          ON o.o_custkey = p.city AND strftime(o.o_orderdate, '%Y-%m-%d') = p.day""",
    "peak_day_drilldown": f"""
        WITH {_PEAKS}, worst AS (SELECT * FROM peaks ORDER BY count DESC, day, city LIMIT 1)
        SELECT o_orderstatus, count(*) AS n
        FROM orders o JOIN worst p ON o.o_custkey = p.city AND strftime(o.o_orderdate, '%Y-%m-%d') = p.day
        GROUP BY 1""",
    "timezone_summary": f"""
        SELECT r_name, count(*) AS n, {sql_round(f'avg({SQL_PRIORITY})', 3)} AS avg_severity
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1 ORDER BY n DESC, r_name LIMIT 10""",
    "rate_by_dimension": f"""
        WITH counts AS (
            SELECT c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
            GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10),
        pops AS (SELECT c_nationkey AS state, count(*) AS pop FROM customer GROUP BY 1)
        SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, n, pop,
               {sql_round('CAST(n AS DOUBLE) / pop', 6)} AS rate
        FROM counts JOIN pops ON c_nationkey = state""",
    "two_level_rate": f"""
        WITH election AS (
            SELECT n_nationkey AS state, CASE WHEN n_regionkey % 2 = 0 THEN 'red' ELSE 'blue' END AS color
            FROM nation),
        pops AS (
            SELECT color, count(*) AS total_pop FROM customer JOIN election ON c_nationkey = state GROUP BY 1),
        events_ AS (
            SELECT color, count(*) AS total_count
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN election ON c_nationkey = state
            GROUP BY 1)
        SELECT color, total_pop, total_count,
               {sql_round('CAST(total_count AS DOUBLE) / total_pop', 6)} AS rate
        FROM pops JOIN events_ USING (color)""",
    "cohort_month_compare": """
        WITH north AS (
            SELECT month(o_orderdate) AS month, count(*) AS count_north FROM orders
            WHERE o_orderstatus = 'O' AND o_totalprice > 400000 GROUP BY 1),
        south AS (
            SELECT month(o_orderdate) AS month, count(*) AS count_south FROM orders
            WHERE o_orderstatus = 'O' AND o_totalprice < 100000 GROUP BY 1)
        SELECT month, count_north, count_south FROM north JOIN south USING (month)""",
}
