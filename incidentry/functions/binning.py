"""Recoding of text columns into a few classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first_match(cases: Sequence[tuple[Column, str]], otherwise: Column) -> Column:
    chain = F
    for condition, label in cases:
        chain = chain.when(condition, F.lit(label))
    return otherwise if chain is F else chain.otherwise(otherwise)


def regex_bin(
    df: DataFrame,
    column: str,
    rules: Sequence[tuple[str, str]],
    default: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """Label each value by the first ``(pattern, label)`` found anywhere in it.

    Patterns are case-sensitive. Values matching none keep their text, or
    become ``default`` when one is given (null included).
    """
    value = F.col(column)
    rest = value if default is None else F.lit(default)
    cases = [(value.rlike(pattern), label) for pattern, label in rules]
    return df.withColumn(out or column, _first_match(cases, rest))


def value_map(
    df: DataFrame,
    column: str,
    groups: Mapping[str, Sequence[str]],
    default: str | None = None,
    out: str | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """Replace listed values by their group's label; see ``regex_bin`` for the rest."""
    value = F.col(column)
    probe = F.upper(value) if ignore_case else value
    cases = [
        (probe.isin([v.upper() if ignore_case else v for v in members]), label)
        for label, members in groups.items()
    ]
    rest = value if default is None else F.lit(default)
    return df.withColumn(out or column, _first_match(cases, rest))
