"""Monthly value added and yearly index, stored by replacing their own slice."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia import constants as K
from apportia import schemas
from apportia.functions import dates
from apportia.operators import results, sinks


def store_value_added(
    docs: DataFrame, registry: DataFrame, munis: DataFrame, path: str, run_id: int,
    window: tuple[str, str], home: str = K.HOME_STATE,
) -> int:
    """Value added of the months of the window; replaces those months, emptied ones included.

    The window is the first day of a month and the last day of one: a stored month is a sum over all its days.
    """
    first, last = (date.fromisoformat(d) for d in window)
    if first.day != 1 or (last + timedelta(days=1)).day != 1 or last < first:
        raise ValueError(f"window {window} does not hold whole months")
    va = results.value_added(docs.where(dates.between_days("emitted_at", *window)), registry, munis, home)
    rows = sinks.align(va.withColumn("run_id", F.lit(run_id)), schemas.VALUE_ADDED)
    inside = F.col("period").between(first.year * 100 + first.month, last.year * 100 + last.month)
    return sinks.replace_rows(docs.sparkSession, rows, path, ["period"], inside, inside)


def store_index(
    spark: SparkSession, va_path: str, munis: DataFrame, path: str, run_id: int, year: int,
    stage: str = "P", home: str = K.HOME_STATE,
) -> int:
    """Index of a year; replaces that year, stage and type."""
    va = spark.read.parquet(va_path).where(F.col("period").between(year * 100 + 1, year * 100 + 12))
    rows = results.municipal_index(va, munis, home).withColumns(
        {"stage": F.lit(stage), "index_type": F.lit(K.INDEX_FULL), "run_id": F.lit(run_id)}
    )
    return sinks.replace_partitions(
        sinks.align(rows, schemas.SHARE_INDEX), path, ["year", "stage", "index_type"]
    ).get["rows"]
