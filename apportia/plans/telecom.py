"""Telecom documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, rules
from apportia.operators import joins, rollups
from apportia.plans import rules as chain
from apportia.plans.references import References


def run(items: DataFrame, op_codes: DataFrame, key: list[str]) -> DataFrame:
    """Value and reason per document; always appropriated on the entry side.

    A cancelled document has no value left and reports reason 12: cancellation is not marked as a
    document-level reason here.
    """
    split = rollups.participation_split(flagged(items, op_codes), key, item_reason="reason")
    return rollups.settle(split, [], document_level=False).withColumn("appropriation", F.lit("E"))


def flagged(items: DataFrame, op_codes: DataFrame) -> DataFrame:
    """Items with ``code_participates`` and their reason."""
    coded = joins.participation_flag(items, op_codes, "op_code", "code", "code_ok")
    # Cancellation is an item column of this source, so it takes part in the item test.
    gone = F.coalesce(F.col("situation") == "S", F.lit(False))
    return coded.withColumns(
        {
            "code_participates": F.col("code_ok") & ~gone,
            "reason": F.when(gone, K.CANCELLED).when(~F.col("code_ok"), K.OP_CODE_OUT),
        }
    )


def load(docs: DataFrame, items: DataFrame, ref: References, run_id: int) -> tuple[DataFrame, DataFrame]:
    """(documents, items) in the unified layout; items of base zero go, a document without items has reason 12."""
    listed = ref.op_codes.where("participates").select("code")
    valued = items.where(F.col("base") != 0).withColumns({
        "op_code": codes.op_code("op_code"), "value_added": rules.telecom_value("rate", "base", "exempt"), "gross": F.col("base"),
    })
    split = run(valued, listed, ["access_key"]).select("access_key", F.col("value_in").alias("value_added"), "reason", F.lit(True).alias("__some"))
    out = docs.join(split, "access_key", "left").withColumns({
        "emitted_at": F.col("emitted"), "appropriation": F.lit("E"), "value_added": rules.amount("value_added"),
        "reason": F.when(F.col("__some"), F.col("reason")).otherwise(K.NO_ITEM_LEFT),
    })
    for side, role in (("exit", "issuer"), ("entry", "recipient")):
        out = out.withColumns({
            f"{side}_reg": codes.registration(f"{role}_reg"), f"{side}_muni": codes.muni_number(f"{role}_muni", 7),
            f"{side}_state": F.upper(F.trim(f"{role}_state")),
        })
    documents = chain.project_documents(out, K.TELECOM, run_id)
    mine = joins.keep_matching(flagged(valued, listed), docs, ["access_key"])
    return documents, chain.project_items(mine, K.TELECOM, run_id)
