"""Named queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from apportia.retail.frames import publish

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name; without SQL only its rows are checked."""

    def add(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return publish(fn(spark, sf))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add
