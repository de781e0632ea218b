"""The order tables under the names of the document model.

A document is an (order, supplier) pair: the customer buys, the supplier sells. Nations are
municipalities, regions are states, and events stand for document events, registry versions and
change logs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOME = "ASIA"
DOC = ["order_key", "supplier_key"]
SUPPLIER_BASE = 1_000_000_000

# Three last digits of the operation code by part type; the first one is the direction.
OP_SUFFIX = {
    "ECONOMY": "101", "STANDARD": "102", "PROMO": "116", "SMALL": "201", "MEDIUM": "410", "LARGE": "949",
}
COUNTED_SUFFIXES = ("101", "102", "116", "201")
COUNTED_CODES = tuple(d + s for d in ("1", "5") for s in COUNTED_SUFFIXES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def publish(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, times and dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            # Not date_format: that would read wall-clock times in the session's zone.
            t = c.cast("string")
            c = F.rpad(F.when(t.contains("."), t).otherwise(F.concat(t, F.lit("."))), 26, "0")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def dec(c: str | Column, ddl: str = "decimal(17,2)") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(ddl)


def part_of(amount: Column, rate: str) -> Column:
    """Share of an amount, rounded to cents."""
    return (amount * dec(rate, "decimal(5,2)")).cast("decimal(17,2)")


def codes_frame(spark: SparkSession, codes: tuple[str, ...] = COUNTED_CODES) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(c) for c in codes])).alias("code"))


def munis(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("muni"),
        F.when(F.col("n_nationkey") >= 20, F.col("n_nationkey") - 5).alias("parent"),
        F.col("r_name").alias("state"), F.col("n_name").alias("name"),
    )


def customer_status() -> Column:
    return F.when(F.col("c_acctbal") >= 0, "1").otherwise("3")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    seg = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("reg"), F.col("c_nationkey").alias("muni"),
        customer_status().alias("status"),
        F.when(seg == "HOUSEHOLD", "4").when(seg == "BUILDING", "3").otherwise("2").alias("regime"),
        seg.isin("FURNITURE", "BUILDING").alias("rural"),
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    bal = F.col("s_acctbal")
    key = F.col("s_suppkey") + F.lit(SUPPLIER_BASE)
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("supplier_key"), key.alias("id"), key.alias("reg"),
        F.col("s_nationkey").alias("muni"),
        F.when(bal >= 0, "1").otherwise("3").alias("status"),
        F.when(bal > 7000, "5").otherwise("2").alias("regime"),
        bal.between(8000, 9000).alias("rural"),
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """Both kinds of party as registry rows with state."""
    rows = customers(spark, sf).unionByName(suppliers(spark, sf).drop("supplier_key"))
    return rows.join(munis(spark, sf).select("muni", "state"), "muni")


def side(df: DataFrame, name: str) -> DataFrame:
    return df.select(
        *(["supplier_key"] if "supplier_key" in df.columns else []),
        *[F.col(c).alias(f"{name}_{c}") for c in ("id", "reg", "muni", "status", "regime", "rural")],
    )


def op_code() -> Column:
    suffix = F.coalesce(*[F.when(F.col("p_type") == t, F.lit(s)) for t, s in OP_SUFFIX.items()])
    return F.concat(F.when(F.col("l_linestatus") == "O", "5").otherwise("1"), suffix)


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with operation and product code and their amounts."""
    line, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    gross = dec("l_extendedprice")
    return line.join(
        part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    ).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_suppkey").alias("supplier_key"),
        F.col("l_linenumber").alias("item_no"), F.col("l_partkey").alias("part_key"),
        op_code().alias("op_code"), F.col("p_brand").alias("product_code"),
        dec("l_quantity", "decimal(19,4)").alias("quantity"), gross.alias("gross"),
        part_of(gross, "l_discount").alias("discount"), part_of(gross, "l_tax").alias("ipi"),
        F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").alias("shipped_at"),
    )


def net_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items with gross minus discount as value added."""
    return items(spark, sf).withColumn(
        "value_added", (F.col("gross") - F.col("discount")).cast("decimal(17,2)")
    )


def with_headers(spark: SparkSession, sf: str, rolled: DataFrame) -> DataFrame:
    """Order, customer and supplier of each rolled-up document; orders get their customer first, as they are fewer."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("entry_id"),
        F.col("o_orderdate").alias("emitted_at"), (F.col("o_orderstatus") == "P").alias("cancelled"),
    )
    return (
        rolled.join(orders.join(side(customers(spark, sf), "entry"), "entry_id"), "order_key")
        .join(side(suppliers(spark, sf), "exit"), "supplier_key")
        .withColumns(
            {
                "period": F.year("emitted_at") * 100 + F.month("emitted_at"),
                "doc_type": F.when(F.year("emitted_at") < 1998, 10).otherwise(2),
            }
        )
    )


def documents(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """Settled documents: appropriation, value and exclusion reason; ``lines`` are the net items, if already stored.

    Lines are dealt by order, which serves both their roll-up and the join of orders.
    """
    from apportia.plans import invoices

    lines = (net_items(spark, sf) if lines is None else lines).select(*DOC, "op_code", "value_added").repartition("order_key")
    rolled = invoices.roll_items(lines, codes_frame(spark), DOC)
    return invoices.settle(with_headers(spark, sf, rolled)).withColumnRenamed("value_in", "value_added")


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("access_key", F.concat_ws("-", *DOC)).drop(*DOC)


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Registry versions from sign-ups, valid for some hours: gaps and overlaps occur."""
    hours = F.floor("value").cast("int")
    return table(spark, sf, "events").where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("reg"), F.lit(HOME).alias("state"), F.col("ts").alias("valid_from"),
        F.when(hours > 0, F.col("ts") + F.make_dt_interval(hours=hours)).alias("valid_to"),
        (hours % 25).alias("muni"), F.when(hours < 10, "1").otherwise("3").alias("status"),
        F.when(hours % 2 == 0, "2").otherwise("4").alias("regime"), (hours % 3 == 0).alias("rural"),
        F.col("event_id"),
    )


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("doc_id"), F.col("user_id").alias("entry_reg"), F.lit(HOME).alias("entry_state"),
        F.col("ts").alias("emitted_at"), dec("value").alias("total"),
    )


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log of old values: the event type names the attribute, the value is the old value."""
    kind = F.col("event_type")
    return table(spark, sf, "events").where(kind != "purchase").select(
        F.col("user_id").alias("reg"), F.col("ts").alias("at"),
        F.when(kind == "signup", "status").when(kind == "click", "regime").when(kind == "view", "muni")
        .otherwise("activity").alias("attr"),
        F.floor("value").cast("bigint").cast("string").alias("old"), F.col("event_id").alias("seq"),
        F.when(kind == "error", F.when(F.col("value") < 15, 1).otherwise(-1)).cast("bigint").alias("activities"),
        F.when((kind == "error") & (F.col("value") < 5), 1).cast("bigint").alias("rural_activities"),
    )
