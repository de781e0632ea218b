"""Rule chains for documents and items, and the final projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import schemas
from apportia.functions import codes, dates, rules
from apportia.operators import joins, sinks
from apportia.plans.references import References


def flag_codes(df: DataFrame, ref: DataFrame, code: str, flag: str) -> DataFrame:
    """Participation flag from a normalised (code, participates) reference; unknown is false.

    The reference, one row per code of a fixed width, is sent to all tasks: few codes hold most rows, so the
    rows are not dealt by code.
    """
    r = ref.select(F.col("code").alias("__code"), F.col("participates").alias("__part"))
    out = df.join(F.broadcast(r), F.col(code) == F.col("__code"), "left")
    return out.withColumn(flag, F.coalesce("__part", F.lit(False))).drop("__code", "__part")


def apply_to_items(items: DataFrame, ref: References) -> DataFrame:
    """Operation and product code flags, value and value added, as far as switched on."""
    s = ref.switches
    out = items.withColumns(
        {"op_code": codes.op_code("op_code"), "product_code": codes.product_code("product_code")}
    )
    for use, table, code, flag in (
        ("USE_OP_CODES", ref.op_codes, "op_code", "code_participates"),
        ("USE_PRODUCTS", ref.products, "product_code", "product_participates"),
    ):
        out = flag_codes(out, table, code, flag) if s[use] else out.withColumn(flag, F.lit(False))
    if s["DROP_OTHER_OP_CODES"]:
        out = out.where("code_participates")
    if s["DROP_OTHER_PRODUCTS"]:
        out = out.where("product_participates")
    return out.withColumn("value_added", rules.value_or_zero("value", "code_participates"))


def apply_to_documents(docs: DataFrame, ref: References) -> DataFrame:
    """Event flags and municipality data, as far as switched on."""
    s = ref.switches
    out = docs
    if s["USE_EVENTS"]:
        out = joins.mark_events(out, ref.events, "access_key")
        out = out.withColumn("event_reason", joins.event_reason(out))
    else:
        out = out.withColumns({f: F.lit(False) for f in ("cancelled", "substituted", "corrected", "voided")})
    if s["USE_MUNICIPALITIES"]:
        for side in ("entry", "exit"):
            out = joins.municipality(
                out, ref.municipalities, f"{side}_muni", f"{side}_muni_state", f"{side}_muni_name"
            )
    if s["DROP_EXCLUDED"]:
        out = out.where(~F.col("cancelled") & ~F.col("substituted") & ~F.col("voided"))
    return out


def project_documents(docs: DataFrame, doc_type: int | None, run_id: int) -> DataFrame:
    """Unified document layout, trimmed key, period from the emission time, null for no reason."""
    out = docs.withColumns(
        {
            "access_key": codes.text("access_key"),
            "period": dates.period("emitted_at"),
            "run_id": F.lit(run_id),
            "reason": F.nullif(F.col("reason").cast("int"), F.lit(0)),
        }
    )
    if doc_type is not None:
        out = out.withColumn("doc_type", F.lit(doc_type))
    return sinks.align(out, schemas.DOCUMENT)


def project_items(items: DataFrame, doc_type: int, run_id: int) -> DataFrame:
    out = items.withColumns(
        {
            "access_key": codes.text("access_key"), "run_id": F.lit(run_id),
            "doc_type": F.lit(doc_type),
        }
    )
    if "reason" not in items.columns:
        out = out.withColumn("reason", F.when(~F.col("code_participates"), F.lit(1)))
    return sinks.align(out, schemas.ITEM)
