"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boxframe.plans.fixtures import Inputs, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of ``Inputs`` under a name, with its check where there is one."""

    def add(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Inputs(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return add
