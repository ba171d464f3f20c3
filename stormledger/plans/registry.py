"""Register of queries: a name, a DataFrame builder and its check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stormledger.plans import oracle
from stormledger.plans.fixtures import Data
from stormledger.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register ``build(d)`` under a name; ``check`` may use the shared SQL blocks."""

    def wrap(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, path: str) -> DataFrame:
            return build(Data(prepare(spark), path))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = oracle.sql(check)
        return build

    return wrap
