"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainlake.registry.adapters import Tables, oracle
from chainlake.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `build(tables) -> DataFrame` under `name`, with the SQL that checks it."""

    def keep(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        run.__name__ = name
        run.__doc__ = build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return keep


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, digits) for c in cols})
