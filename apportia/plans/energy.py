"""Energy bills: lake layout to documents, relational layout to documents and items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, rules
from apportia.operators import joins, rollups
from apportia.plans import rules as chain


def totals(sources: list[DataFrame]) -> DataFrame:
    """First known total and product value per bill over the total tables, in their order."""
    return rollups.first_known(sources, "access_key", ["total", "gross"])


def run(
    head: DataFrame, total_sources: list[DataFrame], events: DataFrame, run_id: int,
    home: str = K.HOME_STATE, model: str = "66",
) -> DataFrame:
    docs = head.where((F.col("model") == model) & (F.col("environment") == "1"))
    flags = rollups.coded_events(events, "access_key", "kind", K.ENERGY_SUBSTITUTE)
    docs = joins.mark_events(joins.fan_in(docs, [totals(total_sources)], ["access_key"]), flags, "access_key")
    issuer, recipient = F.upper(F.trim("issuer_state")), F.upper(F.trim("recipient_state"))
    docs = docs.withColumns(
        {
            "emitted_at": F.col("emitted"), "exit_state": issuer, "entry_state": recipient,
            "exit_reg": codes.registration("issuer_reg"), "entry_reg": codes.registration("recipient_reg"),
            "exit_muni": codes.muni_number("issuer_muni", 7), "entry_muni": codes.muni_number("recipient_muni", 7),
            "home_side": rules.home_side(issuer, recipient, codes.state_of("state_code"), home),
            "total": F.coalesce("total", "gross"),
            "reason": rules.document_reason("cancelled", "substituted"),
        }
    ).where(F.col("home_side").isNotNull())
    docs = docs.withColumns(
        {
            "value_added": F.when(F.col("reason").isNull(), rules.amount("total")).otherwise(rules.amount(None)),
            "appropriation": F.when(F.col("reason").isNull(), "S").otherwise("N"),
        }
    )
    return chain.project_documents(docs, K.ENERGY, run_id)


def flag_items(items: DataFrame, op_codes: DataFrame, classes: DataFrame) -> DataFrame:
    """Code and class participation, sign of the class, value and item reason (1 before 2)."""
    out = joins.participation_flag(items, op_codes, "op_code", "code", "code_ok")
    c = classes.select(
        F.col("energy_class").alias("__class"), "direction", F.lit(True).alias("class_ok")
    )
    out = out.join(c, F.col("energy_class") == F.col("__class"), "left").drop("__class")
    out = out.withColumn("class_ok", F.coalesce("class_ok", F.lit(False)))
    return out.withColumns(
        {
            "code_participates": F.col("code_ok") & F.col("class_ok"),
            "value_added": rules.energy_value("value", "direction", "returned"),
            "reason": F.when(~F.col("code_ok"), K.OP_CODE_OUT).when(~F.col("class_ok"), K.ENERGY_CLASS_OUT),
        }
    )


def settle(items: DataFrame, cancelled: DataFrame, key: str = "access_key") -> DataFrame:
    split = rollups.participation_split(items, key, item_reason="reason")
    marks = cancelled.select(key).distinct().withColumn("cancelled", F.lit(True))
    return rollups.settle(split.join(marks, key, "left"), [(F.col("cancelled"), K.CANCELLED)])
