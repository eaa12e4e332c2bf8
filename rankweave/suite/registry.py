"""Name -> query, and name -> the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        ORACLES[name] = sql.strip()
        return fn

    return register
