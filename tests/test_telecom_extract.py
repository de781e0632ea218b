"""Telecom extract: narrow rows through both joins."""

from pyspark.sql import functions as F

from apportia.sources import extracts


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_telecom_value_is_worked_out_before_the_joins(spark):
    keys, people = extracts.TELECOM_KEYS, extracts.TELECOM_RECIPIENT
    one = lambda *names: [F.lit(19960105 if n == "day" else 1).alias(n) for n in names]
    docs = spark.range(2).select(*one(*keys), F.col("id").alias("head"))
    amounts = [F.col("id").cast("decimal(17,2)").alias("base"), F.lit(2).cast("decimal(17,2)").alias("exempt"), F.lit(0.5).alias("rate")]
    items = spark.range(3).select(*one(*keys, *people), *amounts)
    recipients = spark.range(1).select(*one(*people))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = extracts.telecom(docs, items, recipients, 19960101, 19961231)
        above = plan(out.select("period", "value_added")).rsplit("Join", 1)[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "exempt" not in above and "base" not in above
    assert sorted((r["head"], r["period"], int(r["value_added"])) for r in out.collect()) == [(0, 199601, 3), (0, 199601, 4), (1, 199601, 3), (1, 199601, 4)]
    assert extracts.telecom(docs, items, recipients, 19970101, 19971231).count() == 0
