"""Registered queries over the given tables, each with an independent SQL statement of its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from gristmill.queries import files, generation, judging, linked, records, texts

    found: dict[str, Query] = {}
    for module in (records, texts, judging, generation, linked, files):
        found.update(module.QUERIES)
    return found


def all_sql() -> dict[str, str]:
    from gristmill.queries import files, generation, judging, linked, records, texts

    found: dict[str, str] = {}
    for module in (records, texts, judging, generation, linked, files):
        found.update(module.SQL)
    return found
