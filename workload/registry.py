"""The list of queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The driver's tables hold timestamps without a zone; UTC keeps them as they are.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        key = name or function.__name__
        if key in _queries:
            raise ValueError(f"query {key} is registered twice")
        _queries[key] = run
        if sql is not None:
            _oracles[key] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
