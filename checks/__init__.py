"""The registered queries and the SQL each is compared with.

Every module holds ``QUERIES`` (name -> callable(spark, sf_dir)) and ``ORACLE``
(name -> SQL over the same tables).
"""

from . import (
    aggregates,
    calendar,
    classifiers,
    cleaning,
    flags_and_bins,
    joins,
    profiles,
    reports,
    samples,
    storage,
)

_MODULES = [
    calendar, aggregates, joins, cleaning, flags_and_bins, profiles, storage, samples,
    classifiers, reports,
]


def all_queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
