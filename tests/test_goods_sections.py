"""Section tables of goods invoices from the order tables."""

from pyspark.sql import functions as F

from apportia.operators import joins
from apportia.retail import load_queries


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def small_tables(spark, folder):
    put = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")
    put("orders", [(1, 7, "2-HIGH", 10.0)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_totalprice double")
    spark.read.parquet(f"{folder}/orders.parquet").withColumn("o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz")).write.parquet(f"{folder}/dated")
    spark.read.parquet(f"{folder}/dated").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    put("customer", [(7, 3, 1.0, "X", "n")], "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string, c_name string")
    put("nation", [(3, "n", 1)], "n_nationkey int, n_name string, n_regionkey int")
    put("region", [(1, "ASIA")], "r_regionkey int, r_name string")
    put("events", [(3, 1, "signup", 1.0)], "event_id bigint, user_id bigint, event_type string, value double")
    spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.lit("1996-01-01").cast("timestamp_ntz")).write.parquet(f"{folder}/timed")
    spark.read.parquet(f"{folder}/timed").write.mode("overwrite").parquet(f"{folder}/events.parquet")
    lines = [
        (1, 1, 10.0, "O", "R"), (1, 1, 5.0, "F", "A"),  # greatest texts: O and R
        (1, 2, 10.0, "O", "R"), (1, 2, 10.0, "P", "S"),  # greater ones than these
        (1, 3, 10.0, None, None), (1, 3, 10.0, "O", "R"), (1, 4, 10.0, None, None), (2, 1, 10.0, "O", "R"),
    ]
    put("lineitem", [(k, n, g, 0.0, 0.1, 1.0, s, r) for k, n, g, s, r in lines],
        "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_quantity double, l_linestatus string, l_returnflag string")


def test_goods_sections_share_stored_rows(spark, tmp_path):
    small_tables(spark, f"file://{tmp_path}")
    catalog = load_queries.goods_catalog(spark, f"file://{tmp_path}")
    for name in ("goods_header", "goods_issuer", "goods_recipient", "goods_total"):
        assert "Join" not in plan(catalog[name]) and catalog[name].count() == 1
    for name in ("goods_item_tax", "goods_item_ipi"):
        assert "Aggregate" not in plan(catalog[name])
    assert {(r["det_nitem"], r["cfop"]) for r in catalog["goods_item"].collect()} == {(1, "5.101"), (2, "1949"), (3, "5.101"), (4, "1949")}
    assert {(r["chavenfe"], r["det_nitem"]) for r in catalog["goods_item_ipi"].collect()} == {("1", 1), ("1", 3), ("2", 1)}
    assert catalog["goods_item_tax"].count() == 5


def test_sections_of_documents_are_not_sent_to_the_driver(spark, tmp_path):
    """Sections small on disk have as many rows as there are documents."""
    put = lambda df, name: df.write.parquet(f"file://{tmp_path}/{name}") or spark.read.parquet(f"file://{tmp_path}/{name}")
    base = put(spark.range(20).select(F.col("id").cast("string").alias("access_key")), "base")
    part = put(spark.range(10).select(F.col("id").cast("string").alias("access_key"), (F.col("id") % 3).alias("total")), "part")
    flags = put(spark.range(5).select(F.col("id").cast("string").alias("access_key"), F.lit(True).alias("cancelled")), "flags")
    out = joins.mark_events(joins.fan_in(base, [part], ["access_key"]), flags, "access_key")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    want = {(str(i), i % 3 if i < 10 else None, i < 5) for i in range(20)}
    assert {tuple(r) for r in out.select("access_key", "total", "cancelled").collect()} == want


def test_goods_items_are_dated_without_sending_orders_to_the_driver(spark, tmp_path):
    small_tables(spark, f"file://{tmp_path}")
    item = load_queries.goods_catalog(spark, f"file://{tmp_path}")["goods_item"]
    assert "Broadcast" not in item._jdf.queryExecution().executedPlan().toString()
