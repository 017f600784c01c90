"""Every operator as a query over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from . import areas, feeds, inheritance, legacy, payloads, quality, state

    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for module in (feeds, state, inheritance, areas, quality, legacy, payloads):
        queries |= module.Q.queries
        sql |= module.Q.sql
    return queries, sql
