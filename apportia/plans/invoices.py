"""Relational load of invoices: items and parties to settled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import rules
from apportia.operators import joins, rollups


def roll_items(items: DataFrame, op_codes: DataFrame, keys: list[str]) -> DataFrame:
    """Items flagged against the code list and reduced to one row per document."""
    flagged = joins.participation_flag(items, op_codes, "op_code", "code", "code_participates")
    return rollups.participation_split(flagged, keys)


def settle(docs: DataFrame) -> DataFrame:
    """Appropriation, participating value and exclusion reason of rolled-up documents.

    Takes the columns of ``roll_items`` plus cancelled and, per side, status, regime and rural.
    """
    sides = [(f"{s}_status", f"{s}_regime", f"{s}_rural") for s in ("entry", "exit")]
    out = docs.withColumn("appropriation", rules.appropriation(*sides))
    parties_out = rules.both_parties_out(sides[0][:2], sides[1][:2])
    return rollups.settle(out, [(F.col("cancelled"), K.CANCELLED), (parties_out, K.PARTIES_OUT)])


def item_reasons(items: DataFrame, docs: DataFrame, keys: list[str]) -> DataFrame:
    """Reason of each item: its code, overridden by the document's cancellation or parties."""
    marks = docs.select(*keys, "cancelled", "parties_out")
    own = F.when(~F.col("code_participates"), K.OP_CODE_OUT)
    reason = F.when(F.col("parties_out"), K.PARTIES_OUT).when(F.col("cancelled"), K.CANCELLED).otherwise(own)
    return items.join(marks, keys, "left").withColumn("reason", reason.cast("int")).drop("cancelled", "parties_out")
