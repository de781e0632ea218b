"""Digital ledger: documents, items and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, dates, rules
from apportia.operators import joins, rollups, sinks
from apportia.plans import rules as chain
from apportia.plans.references import References

KEY_COLUMNS = ["company", "person", "model", "series", "number", "day"]


def keyed(df: DataFrame) -> DataFrame:
    """Document key from tax number, model, series, number and day, with the parsed day."""
    day = dates.parse_ledger_date("day")
    tax = F.coalesce(codes.blank_to_null("company"), codes.blank_to_null("person"))
    key = codes.ledger_key(tax, F.col("model"), F.col("series"), F.col("number"), day)
    return df.withColumns({"access_key": key, "emitted_on": day})


def items(df: DataFrame) -> DataFrame:
    """Ledger items under the invoice item names."""
    return keyed(df).select(
        "access_key", "item_no", "op_code", F.lit(None).cast("string").alias("product_code"), "gross",
        "discount", "ipi", "quantity",
        rules.item_value("gross", discount="discount").alias("value"),
    )


def run(
    docs: DataFrame, rows: DataFrame, periods: DataFrame, ref: References, run_id: int
) -> tuple[DataFrame, DataFrame]:
    """Participating by operation code only; documents learn whether their day is in a period."""
    flagged = chain.apply_to_items(items(rows), ref).withColumn("item_doc_type", F.lit(0))
    rolled = rollups.item_rollup(flagged, "access_key")
    heads = keyed(docs).withColumn("emitted_at", F.col("emitted_on").cast("timestamp"))
    heads = sinks.one_per_key(heads, ["access_key"])
    placed = joins.in_period(heads, periods.select("start", "stop"), "emitted_on", "start", "stop")
    marked = placed.groupBy("access_key", "emitted_at", "total").agg(F.bool_or("in_period").alias("in_period"))
    out = joins.fan_in(marked, [rolled], ["access_key"]).withColumns(
        {
            "appropriation": F.when(F.col("code_participates"), "S").otherwise("N"),
            "value_added": rules.amount("value_added"),
            "reason": F.when(~F.coalesce("code_participates", F.lit(False)), K.NO_ITEM_LEFT),
        }
    )
    return chain.project_documents(out, K.LEDGER, run_id), chain.project_items(flagged, K.LEDGER, run_id)


def settle(rows: DataFrame, key: str = "access_key") -> DataFrame:
    """Relational load: the operation code alone decides."""
    return rollups.settle(rollups.participation_split(rows, key), [])
