"""Boolean flags, text bins and map coordinates (lineitem, part, events)."""

from pyspark.sql import functions as F

from incidentry import (
    any_flag,
    constant,
    count_by,
    flag_totals,
    flags_long,
    flags_to_int,
    regex_bin,
    scaled,
    value_map,
    web_mercator,
)

from .common import as_long, rounded, sql_round, table

FLAGS = ["big_discount", "untaxed", "bulk", "is_open"]


def flagged_lines(spark, sf):
    """Line items with four flags; one of them is null on some rows."""
    return table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("severity"),
        (F.col("l_discount") > 0.05).alias("big_discount"),
        (F.col("l_tax") == 0).alias("untaxed"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity") > 25).alias("bulk"),
        (F.col("l_linestatus") == "O").alias("is_open"),
    )


def flag_presence_counts(spark, sf):
    return count_by(any_flag(flagged_lines(spark, sf), FLAGS, "has_any"), ["has_any"], "n")


def flag_severity_counts(spark, sf):
    lines = any_flag(flagged_lines(spark, sf), FLAGS, "has_any")
    counts = constant(count_by(lines, ["severity", "has_any"], "n"), "source", "lineitem")
    flagged = F.when(F.col("has_any"), "yes").when(~F.col("has_any"), "no").alias("flagged")
    return as_long(counts.select("source", "severity", flagged, "n"), "severity")


def flag_sums(spark, sf):
    return flag_totals(flagged_lines(spark, sf), FLAGS)


def flag_sums_by_severity(spark, sf):
    lines = flags_to_int(flagged_lines(spark, sf), FLAGS)
    return as_long(flag_totals(lines, FLAGS, ["severity"]), "severity").orderBy("severity")


def flag_sums_long(spark, sf):
    totals = flag_totals(flagged_lines(spark, sf), FLAGS, ["severity"])
    return as_long(flags_long(totals, FLAGS, ["severity"]), "severity", "count")


RULES = [("red|blue", "Coloured"), ("hot|cold", "Thermal"), ("gear|bolt|rod", "Hardware")]


def regex_bin_counts(spark, sf):
    return count_by(regex_bin(table(spark, sf, "part").select("p_name"), "p_name", RULES), ["p_name"], "n")


def regex_bin_default(spark, sf):
    binned = regex_bin(table(spark, sf, "part").select("p_name"), "p_name", RULES, "Other", "kind")
    return count_by(binned, ["kind"], "n")


GROUPS = {"Engage": ["click", "VIEW"], "Convert": ["purchase", "signup"]}


def value_map_counts(spark, sf):
    events = table(spark, sf, "events").select("event_type")
    kept = value_map(events, "event_type", GROUPS, out="exact")
    loose = value_map(kept, "event_type", GROUPS, "Other", out="loose", ignore_case=True)
    return count_by(loose, ["exact", "loose"], "n")


def mercator(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", (F.col("value") - 180).alias("lon"), (F.col("value") / 10).alias("lat"), "value"
    )
    points = scaled(web_mercator(events, "lon", "lat"), "value", 4.0, "size")
    return rounded(points.select("event_id", "merc_x", "merc_y", "size"), 2, "merc_x", "merc_y", "size")


QUERIES = {
    "flag_presence_counts": flag_presence_counts,
    "flag_severity_counts": flag_severity_counts,
    "flag_totals": flag_sums,
    "flag_totals_by_severity": flag_sums_by_severity,
    "flag_totals_long": flag_sums_long,
    "regex_bin_counts": regex_bin_counts,
    "regex_bin_default": regex_bin_default,
    "value_map_counts": value_map_counts,
    "web_mercator": mercator,
}

_FLAGGED = """
    flagged AS (
        SELECT CAST(l_linenumber AS BIGINT) AS severity, l_discount > 0.05 AS big_discount,
               l_tax = 0 AS untaxed, CASE WHEN l_partkey % 5 <> 0 THEN l_quantity > 25 END AS bulk,
               l_linestatus = 'O' AS is_open
        FROM lineitem),
    marked AS (
        SELECT *, coalesce(big_discount OR untaxed OR bulk OR is_open, FALSE) AS has_any FROM flagged)"""
_SUMS = ", ".join(f"CAST(sum(CAST({f} AS INT)) AS BIGINT) AS {f}" for f in FLAGS)


def _cases(otherwise: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(p_name, '{p}') THEN '{label}'" for p, label in RULES)
    return f"CASE {whens} ELSE {otherwise} END"


ORACLE = {
    "flag_presence_counts": f"WITH {_FLAGGED} SELECT has_any, count(*) AS n FROM marked GROUP BY 1",
    "flag_severity_counts": f"""
        WITH {_FLAGGED}
        SELECT 'lineitem' AS source, severity, CASE WHEN has_any THEN 'yes' ELSE 'no' END AS flagged,
               count(*) AS n
        FROM marked GROUP BY 1, 2, 3""",
    "flag_totals": f"WITH {_FLAGGED} SELECT {_SUMS} FROM flagged",
    "flag_totals_by_severity": f"WITH {_FLAGGED} SELECT severity, {_SUMS} FROM flagged GROUP BY 1",
    "flag_totals_long": f"WITH {_FLAGGED} " + " UNION ALL ".join(
        f"SELECT severity, '{f}' AS flag, CAST(sum(CAST({f} AS INT)) AS BIGINT) AS count FROM flagged GROUP BY 1"
        for f in FLAGS
    ),
    "regex_bin_counts": f"SELECT {_cases('p_name')} AS p_name, count(*) AS n FROM part GROUP BY 1",
    "regex_bin_default": f"SELECT {_cases(chr(39) + 'Other' + chr(39))} AS kind, count(*) AS n FROM part GROUP BY 1",
    "value_map_counts": """
        SELECT CASE WHEN event_type IN ('click', 'VIEW') THEN 'Engage'
                    WHEN event_type IN ('purchase', 'signup') THEN 'Convert' ELSE event_type END AS exact,
               CASE WHEN upper(event_type) IN ('CLICK', 'VIEW') THEN 'Engage'
                    WHEN upper(event_type) IN ('PURCHASE', 'SIGNUP') THEN 'Convert' ELSE 'Other' END AS loose,
               count(*) AS n
        FROM events GROUP BY 1, 2""",
    "web_mercator": f"""
        SELECT event_id, {sql_round('6378137.0::DOUBLE * radians(value - 180)', 2)} AS merc_x,
               {sql_round('6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(value / 10) / 2))', 2)} AS merc_y,
               {sql_round('value * 4', 2)} AS size
        FROM events""",
}
