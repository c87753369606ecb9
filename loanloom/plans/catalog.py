"""Registered queries: name -> Spark query and, where it exists, the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanloom.plans.oracle_prefix import PREFIX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, prefix: bool = True):
    """Register a query; ``sql`` follows the shared common table expressions."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            joiner = "," if text[:4] != "WITH" and text.split(None, 2)[1:2] == ["AS"] else ""
            ORACLE[name] = f"{PREFIX}{joiner}{text}" if prefix else text
        return fn

    return add
