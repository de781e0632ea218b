"""Reference loads and stored tables."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from apportia.plans import reference_loads as refs
from apportia.plans import store


def test_op_codes(spark, rows):
    stored = spark.createDataFrame([], "code string, start date, stop date, doc_type int")
    file = spark.createDataFrame([("5.101",), ("510",), ("x",), ("5101",)], "code string")
    once = refs.op_codes(stored, file, "2024-01-01", 10)
    assert rows(once, "code", "doc_type") == [("0510", 10), ("5101", 10)]
    assert refs.op_codes(once, file, "2024-01-01", 10).count() == 2
    assert refs.op_codes(once, file, "2025-01-01", 10).count() == 4
    assert refs.drop_op_codes(once, 2024, 10).count() == 0 and refs.drop_op_codes(once, 2024, 2).count() == 2


def test_coded_branches_map_and_reasons(spark, rows):
    known = spark.createDataFrame([("0111301", 7), ("0112101", 8)], "code string, id int")
    file = spark.createDataFrame([("111301",), ("999",)], "activity string").withColumn("branch", F.lit("farm"))
    assert rows(refs.coded(file, known, "activity", 7, "2024-01-01"), "code", "id") == [("0111301", 7)]
    assert rows(refs.activity_branches(file, known)) == [(None, "farm"), (7, "farm")]
    munis = spark.createDataFrame([(10,)], "muni int")
    pairs = spark.createDataFrame([("0501", "10"), ("7", "99")], "revenue_code string, muni string")
    assert rows(refs.municipality_map(pairs, munis)) == [(501, 10)]
    levels = {r["reason"]: r["level"] for r in refs.exclusion_reasons(spark).collect()}
    assert levels[4] == "item" and levels[10] == "document" and len(levels) == 9
    p = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, value string")
    assert rows(refs.parameters(p, spark.createDataFrame([("b", "3")], p.schema))) == [("a", "1"), ("b", "3")]


def test_store_replaces_and_checks(spark, tmp_path):
    docs = spark.createDataFrame(
        [("k1", 0, 5, D(3), None), ("k2", 7, 5, D(0), 12)],
        "access_key string, entry_reg bigint, exit_reg bigint, value_added decimal(17,2), reason int",
    ).withColumn("emitted_at", F.lit("2024-01-05 00:00:00").cast("timestamp"))
    items = spark.createDataFrame([("k1", 1, "5101", True), ("k2", 1, "5949", False)], "access_key string, item_no int, op_code string, code_participates boolean")
    d, i, x = (str(tmp_path / n) for n in "dix")
    for run in (1, 2):
        assert store.documents(spark, docs, d, run, 10) == 2
    saved = spark.read.parquet(d)
    assert {(r["access_key"], r["entry_reg"], r["run_id"]) for r in saved.collect()} == {("k1", None, 2), ("k2", D(7), 2)}
    assert store.items(spark, items, saved, i, 2, 10) == 2
    assert {(r["access_key"], r["reason"]) for r in spark.read.parquet(i).collect()} == {("k1", None), ("k2", 1)}
    assert store.excluded(saved, x) == 1
    store.clear(spark, d, str(tmp_path / "kept"), 2)
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 2
    with pytest.raises(Exception):
        store.clear(spark, d, str(tmp_path / "none"), 10)
        spark.read.parquet(str(tmp_path / "none"))
