"""Missing values, sentinels and text clean-up (events, documents)."""

from pyspark.sql import functions as F

from incidentry import drop_sentinels, fill_defaults, null_report, strip_chars

from .common import table

DEFAULTS = {"value": -999.0, "event_type": "event_typeEmpty", "ts": "0001-01-01 00:00:00"}


def events_with_gaps(spark, sf):
    """The events, with gaps made in three columns (the tables have none)."""
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", "user_id",
        F.when(key % 7 != 0, F.col("value")).alias("value"),
        F.when(key % 11 != 0, F.col("event_type")).alias("event_type"),
        F.when(key % 13 != 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("ts"),
    )


def gaps(spark, sf):
    return null_report(events_with_gaps(spark, sf))


def filled(spark, sf):
    events = fill_defaults(events_with_gaps(spark, sf), DEFAULTS)
    return events.withColumn("ts", F.col("ts").cast("string"))


def gaps_after_fill(spark, sf):
    return null_report(fill_defaults(events_with_gaps(spark, sf), DEFAULTS))


def without_sentinels(spark, sf):
    events = fill_defaults(events_with_gaps(spark, sf), DEFAULTS)
    sentinels = {c: DEFAULTS[c] for c in ("value", "event_type")}
    return drop_sentinels(events, sentinels).select("event_id", "value", "event_type")


def stripped(spark, sf):
    slashed = F.concat(F.lit("\\"), F.col("text"), F.lit("\\\\end"))
    documents = table(spark, sf, "documents").select("doc_id", slashed.alias("text"))
    clean = strip_chars(documents, "text")
    return clean.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )


QUERIES = {
    "null_report": gaps,
    "fill_defaults": filled,
    "null_report_after_fill": gaps_after_fill,
    "sentinel_filter": without_sentinels,
    "strip_chars": stripped,
}

_GAPS = """
    gaps AS (
        SELECT event_id, user_id,
               CASE WHEN event_id % 7 <> 0 THEN value END AS value,
               CASE WHEN event_id % 11 <> 0 THEN event_type END AS event_type,
               CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END AS ts
        FROM events)"""
_FILLED = f"""{_GAPS},
    filled AS (
        SELECT event_id, user_id, coalesce(value, -999.0) AS value,
               coalesce(event_type, 'event_typeEmpty') AS event_type,
               coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S'), '0001-01-01 00:00:00') AS ts
        FROM gaps)"""


def _report(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS null_count FROM {source} WHERE {c} IS NULL HAVING count(*) > 0"
        for c in ("event_id", "user_id", "value", "event_type", "ts")
    )


ORACLE = {
    "null_report": f"WITH {_GAPS} {_report('gaps')}",
    "fill_defaults": f"WITH {_FILLED} SELECT event_id, user_id, value, event_type, ts FROM filled",
    "null_report_after_fill": f"WITH {_FILLED} {_report('filled')}",
    "sentinel_filter": f"""
        WITH {_FILLED} SELECT event_id, value, event_type FROM filled
        WHERE value <> -999.0 AND event_type <> 'event_typeEmpty'""",
    "strip_chars": """
        WITH clean AS (
            SELECT doc_id, replace(concat('\\', text, '\\\\end'), '\\', '') AS text FROM documents)
        SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM clean""",
}
