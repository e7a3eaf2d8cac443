"""All registered queries of the engine and the SQL that an oracle can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import ship
from . import federated, relational, web


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(f) for name, f in {**relational.queries(), **federated.queries(), **web.queries()}.items()}


def _shipped(query):
    """Python operators need the package on the executors."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship.ship(spark)
        return query(spark, sf)

    return run


def oracle_sql() -> dict[str, str]:
    return {**relational.oracle_sql(), **federated.oracle_sql(), **web.oracle_sql()}
