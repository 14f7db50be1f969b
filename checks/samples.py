"""Rebalancing and splits (orders, with an uneven class made from the price)."""

from pyspark.sql import functions as F

from incidentry import WHOLE_ROW, count_by, oversample, oversample_random, split, undersample, union_all

from .common import as_long, sql_hash, table

# Class 1 is far the largest; class 4 is in no fraction list.
FRACTIONS = {1: 0.4, 2: 1.0, 3: 0.9}


def priced_classes(spark, sf):
    price = F.col("o_totalprice")
    label = (
        F.when(price < 300000, 1).when(price < 420000, 2).when(price < 470000, 3).otherwise(4)
    )
    return table(spark, sf, "orders").select("o_orderkey", label.alias("class"))


def undersample_hash(spark, sf):
    return as_long(undersample(priced_classes(spark, sf), "class", FRACTIONS, "o_orderkey", 10), "class")


def _drawn(spark, sf, drawn, expected, spread):
    """Per class: rows of the input, drawn rows that are not among them, and
    whether as many were drawn as expected, within five standard deviations."""
    rows = as_long(priced_classes(spark, sf), "class")
    sizes = count_by(rows, ["class"], "n_input")
    got = as_long(drawn, "class")
    strange = count_by(got.join(rows, ["o_orderkey", "class"], "left_anti"), ["class"], "n_strange")
    near = F.abs(F.col("n") - expected) <= F.lit(5.0) * F.sqrt(spread) + 1
    return (
        count_by(got, ["class"], "n").join(sizes, "class", "left").join(strange, "class", "left")
        .select("class", "n_input", F.coalesce("n_strange", F.lit(0).cast("bigint")).alias("n_strange"),
                near.alias("near"))
    )


def undersample_random(spark, sf):
    drawn = undersample(priced_classes(spark, sf), "class", FRACTIONS, seed=10)
    part = F.element_at(F.create_map(*[F.lit(x) for kv in FRACTIONS.items() for x in kv]), F.col("class").cast("int"))
    return _drawn(spark, sf, drawn, F.col("n_input") * part, F.col("n_input") * part * (1 - part))


def oversample_balanced(spark, sf):
    return as_long(oversample(priced_classes(spark, sf), "class", "o_orderkey", 10), "class")


def oversample_drawn(spark, sf):
    drawn = oversample_random(priced_classes(spark, sf), "class", [1, 2, 3], 10, "o_orderkey")
    top = count_by(priced_classes(spark, sf), ["class"]).agg(F.max("count")).scalar()
    return _drawn(spark, sf, drawn, top, top)


def hash_split(spark, sf):
    train, test = split(priced_classes(spark, sf), 0.8, "o_orderkey", 11)
    return as_long(
        union_all([train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]),
        "class",
    )


def random_split(spark, sf):
    train, test = split(priced_classes(spark, sf), 0.8, seed=11)
    both = union_all([train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))])
    return as_long(both, "class").drop("part")  # which part a row got is random, the rows are not


def random_split_sizes(spark, sf):
    """Rows and keys of both parts, keys in both, and whether the parts are as large as asked for."""
    train, test = split(priced_classes(spark, sf), 0.8, seed=11)
    both = train.join(test, "o_orderkey", "left_semi").agg(F.count("*")).scalar()
    parts = union_all([train.withColumn("part", F.lit(1)), test.withColumn("part", F.lit(0))])
    return parts.agg(
        F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"),
        (F.abs(F.avg("part") - 0.8) <= F.lit(5.0) * F.sqrt(F.lit(0.16) / F.count("*"))).alias("near"),
    ).withColumn("in_both", both)


def keyless_rows(spark, sf):
    """Line items of three columns, so that many rows are equal; two thirds have no key, some no class."""
    part = F.col("l_partkey")
    return table(spark, sf, "lineitem").select(
        F.when(part % 3 == 0, part).alias("key"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber") % 3).alias("class"), F.col("l_tax").alias("tax"),
    )


def _parts(rows, keep):
    """Rows, rows kept and whether as many as asked for were, per kind of row."""
    kind = F.when(F.col("key").isNull(), "keyless").otherwise("keyed")
    sizes = rows.groupBy("class", kind.alias("kind")).agg(F.count("*").alias("n"), F.count_if("kept").alias("n_kept"))
    sure = F.lit(5.0) * F.sqrt(F.col("n") * keep * (1 - keep)) + 1
    # rows with one key go together, some thirty of them
    near = F.abs(F.col("n_kept") - F.col("n") * keep) <= F.when(F.col("kind") == "keyed", sure * 8).otherwise(sure)
    return as_long(sizes.select("class", "kind", "n", near.alias("near")), "class")


def split_without_keys(spark, sf):
    train, test = split(keyless_rows(spark, sf), 0.8, "key", 11)
    return _parts(union_all([train.withColumn("kept", F.lit(True)), test.withColumn("kept", F.lit(False))]), F.lit(0.8))


def split_whole_rows(spark, sf):
    """Equal rows are told apart by a running number, so each goes its own way."""
    train, test = split(keyless_rows(spark, sf), 0.8, WHOLE_ROW, 11)
    return _parts(union_all([train.withColumn("kept", F.lit(True)), test.withColumn("kept", F.lit(False))]), F.lit(0.8))


def undersample_without_keys(spark, sf):
    kept = undersample(keyless_rows(spark, sf), "class", {0: 0.5, 1: 1.0, 2: 0.1}, "key", 5)
    sizes = count_by(kept.select(F.col("class"), F.col("key").isNull().alias("keyless")), ["class", "keyless"], "n_kept")
    whole = count_by(
        keyless_rows(spark, sf).select(F.col("class"), F.col("key").isNull().alias("keyless")), ["class", "keyless"], "n"
    )
    part = F.when(F.col("class") == 0, 0.5).when(F.col("class") == 1, 1.0).otherwise(0.1)
    sure = (F.lit(5.0) * F.sqrt(F.col("n") * part * (1 - part)) + 1) * F.when(F.col("keyless"), 1).otherwise(8)
    near = F.abs(F.col("n_kept") - F.col("n") * part) <= sure
    return as_long(sizes.join(whole, ["class", "keyless"]).select("class", "keyless", "n", near.alias("near")), "class")


def union_classes(spark, sf):
    rows = priced_classes(spark, sf)
    return as_long(union_all([rows.filter(F.col("class") == c) for c in (1, 2, 2)]), "class")


QUERIES = {
    "undersample_hash": undersample_hash,
    "undersample_random": undersample_random,
    "oversample_balanced": oversample_balanced,
    "oversample_random": oversample_drawn,
    "hash_split": hash_split,
    "random_split": random_split,
    "random_split_sizes": random_split_sizes,
    "split_without_keys": split_without_keys,
    "split_whole_rows": split_whole_rows,
    "undersample_without_keys": undersample_without_keys,
    "union_classes": union_classes,
}

SQL_KEYLESS = """
    keyless AS (
        SELECT CASE WHEN l_partkey % 3 = 0 THEN l_partkey END AS key,
               CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber % 3 AS BIGINT) END AS class, l_tax
        FROM lineitem)"""
_SQL_PARTS = f"""
    WITH {SQL_KEYLESS} SELECT class, CASE WHEN key IS NULL THEN 'keyless' ELSE 'keyed' END AS kind, count(*) AS n,
        TRUE AS near FROM keyless GROUP BY 1, 2"""

SQL_CLASSES = """
    classes AS (
        SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 300000 THEN 1 WHEN o_totalprice < 420000 THEN 2
                                     WHEN o_totalprice < 470000 THEN 3 ELSE 4 END AS BIGINT) AS class
        FROM orders)"""

ORACLE = {
    "undersample_hash": f"""
        WITH {SQL_CLASSES} SELECT o_orderkey, class FROM classes
        WHERE {sql_hash('o_orderkey', 10)} <
              CASE class WHEN 1 THEN 0.4 WHEN 2 THEN 1.0 WHEN 3 THEN 0.9 ELSE 0 END""",
    "oversample_balanced": f"""
        WITH {SQL_CLASSES},
        sizes AS (SELECT class, count(*) AS n FROM classes GROUP BY 1),
        ratios AS (SELECT class, CAST(max(n) OVER () AS DOUBLE) / n AS ratio FROM sizes),
        copies AS (
            SELECT o_orderkey, class, CAST(floor(ratio) AS BIGINT)
                   + CASE WHEN {sql_hash('o_orderkey', 10)} < ratio - floor(ratio) THEN 1 ELSE 0 END AS n
            FROM classes JOIN ratios USING (class))
        SELECT o_orderkey, class FROM (SELECT o_orderkey, class, unnest(range(n)) FROM copies)""",
    "hash_split": f"""
        WITH {SQL_CLASSES} SELECT o_orderkey, class,
               CASE WHEN {sql_hash('o_orderkey', 11)} < 0.8 THEN 'train' ELSE 'test' END AS part
        FROM classes""",
    "undersample_random": f"""
        WITH {SQL_CLASSES} SELECT class, count(*) AS n_input, 0::BIGINT AS n_strange, TRUE AS near
        FROM classes WHERE class IN (1, 2, 3) GROUP BY class""",
    "oversample_random": f"""
        WITH {SQL_CLASSES} SELECT class, count(*) AS n_input, 0::BIGINT AS n_strange, TRUE AS near
        FROM classes WHERE class IN (1, 2, 3) GROUP BY class""",
    "random_split": f"WITH {SQL_CLASSES} SELECT o_orderkey, class FROM classes",
    "random_split_sizes": f"""
        WITH {SQL_CLASSES} SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, TRUE AS near,
               0::BIGINT AS in_both FROM classes""",
    "split_without_keys": _SQL_PARTS,
    "split_whole_rows": _SQL_PARTS,
    "undersample_without_keys": f"""
        WITH {SQL_KEYLESS} SELECT class, key IS NULL AS keyless, count(*) AS n, TRUE AS near
        FROM keyless WHERE class IS NOT NULL GROUP BY 1, 2""",
    "union_classes": f"""
        WITH {SQL_CLASSES}
        SELECT o_orderkey, class FROM classes WHERE class = 1
        UNION ALL SELECT o_orderkey, class FROM classes WHERE class = 2
        UNION ALL SELECT o_orderkey, class FROM classes WHERE class = 2""",
}
