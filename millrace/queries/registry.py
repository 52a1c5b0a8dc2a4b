"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure

QueryFunction = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under its function name; without ``oracle`` only its rows are checked."""

    def register(build: QueryFunction) -> QueryFunction:
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return build

    return register
