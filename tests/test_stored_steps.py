"""Frames that several steps read are stored by column."""

import pytest
from pyspark.sql import functions as F

from apportia import session


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stored_frame_is_read_by_column(spark):
    df = session.cut_lineage(spark.range(3).select("id", F.struct(F.lit("x").alias("t")).alias("s"), F.lit(1).alias("n")))
    assert "ReadSchema: struct<n:int>" in df.select("n")._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["s"]["t"], r["n"]) for r in df.collect()) == [(0, "x", 1), (1, "x", 1), (2, "x", 1)]


@pytest.mark.parametrize("extra", ["NULL AS nothing", "1 AS ID"])
def test_frame_that_parquet_cannot_hold_is_checkpointed(spark, extra):
    df = session.cut_lineage(spark.range(3).selectExpr("id", extra))
    assert df.count() == 3 and "Range" not in plan(df)
