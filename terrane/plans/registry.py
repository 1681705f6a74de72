"""All registered queries of the listing operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrane.plans import backfills, cleaning, matching, statistics, tables, texts
from terrane.plans.registry_type import Query

_ALL: list[Query] = [*statistics.QUERIES, *texts.QUERIES, *tables.QUERIES, *matching.QUERIES, *cleaning.QUERIES, *backfills.QUERIES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.name: q.run for q in _ALL}


def oracle_sql() -> dict[str, str]:
    return {q.name: q.sql for q in _ALL if q.sql}
