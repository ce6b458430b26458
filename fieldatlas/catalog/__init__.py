"""Registered queries over the star-schema tables, each with its plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldatlas.catalog import charts, corpus, network, reports, roundtrips, subqueries, texts

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (reports, corpus, network, subqueries, texts, charts, roundtrips)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
