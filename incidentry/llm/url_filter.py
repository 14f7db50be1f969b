"""Allow and block rules for URLs, looked up by hashed host and path expressions.

A URL is expanded into every suffix of its host at a dot, joined with every
prefix of its path that has the length of some rule's path. The expressions
meet the rules by a short hash prefix; the full digest confirms a match, and
the longest rule decides. Each distinct (host, path) is judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_BYTES = 4
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _host_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row (id, host, path, rule, verdict) per page, repeated rows included.

    ``rules`` has host, path and verdict; a rule fits its host and all
    subdomains, for paths that begin with its own. The longest rule (host and
    path) wins, then the longer host, then the verdict first in the alphabet.
    Without a rule the verdict is ``default`` and the rule null. A null URL, or
    one without ``://``, has an empty host and path and fits no rule. Rules with
    a null or empty host are left out, a null path is empty. URLs of any length are read whole.
    Without pages there are no rows; without rules every verdict is ``default``.
    """
    known = (
        rules.select(
            lower_ascii(F.col("host")).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
        )
        .where("rule_host <> ''")
        .groupBy("rule_host", "rule_path")
        .agg(F.min("rule_verdict").alias("rule_verdict"))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", F.substring("digest", 1, 2 * PREFIX_BYTES))
    )
    # At most one length for each length that a rule's path can have, however many rules there are.
    lengths = sorted(r[0] for r in known.select(F.length("rule_path")).distinct().collect())

    page = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select(
        "id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    address = page.select("host", "path").distinct()
    fitting = F.filter(
        F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")
    )
    expressions = (
        address.where("host <> ''")
        .withColumn("suffix", F.explode(_host_suffixes(F.col("host"))))
        .withColumn("prefix", F.explode(F.transform(fitting, lambda n: F.substr(F.col("path"), F.lit(1), n))))
        .withColumn("full", _digest(F.col("suffix"), F.col("prefix")))
        .select("host", "path", "full", F.substring("full", 1, 2 * PREFIX_BYTES).alias("short"))
    )
    best = (
        expressions.join(known, "short")
        .where(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"),
                F.struct(F.length(F.concat("rule_host", "rule_path")), F.length("rule_host")),
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.rule_verdict")
    )
    return page.join(best, ["host", "path"], "left").select(
        "id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict")
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)
