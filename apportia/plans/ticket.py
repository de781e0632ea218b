"""Passenger tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, dates, rules
from apportia.operators import joins, rollups, spans
from apportia.plans import rules as chain
from apportia.plans.references import References


def event_flags(events: DataFrame) -> DataFrame:
    note = F.upper(F.col("note"))
    return events.groupBy("access_key").agg(
        F.coalesce(F.bool_or(F.col("kind").isin(*K.EVENT_CANCEL)), F.lit(False)).alias("cancelled"),
        F.coalesce(F.bool_or(note.contains(K.NO_BOARDING_TEXT)), F.lit(False)).alias("not_boarded"),
    )


def latest_trip(trips: DataFrame) -> DataFrame:
    return spans.best_row(trips, ["access_key"], ["boarded", "prefix", "seat"])


def number_items(detail: DataFrame) -> DataFrame:
    """Items numbered by trip, else by id; rows alike in both follow a digest of the whole row."""
    placed = detail.withColumns(
        {"__order": F.coalesce("trip_no", "id"), "__tie": F.coalesce("id", F.lit(-1)), "__row": F.xxhash64(*detail.columns)}
    )
    return spans.position(
        placed, ["access_key"], ["__order", "__tie", "__row"], spans.number_span("__order"), "item_no"
    ).drop("__order", "__tie", "__row")


def prepare(parts: dict[str, DataFrame]) -> DataFrame:
    """Tickets with event flags, payment and component sums and the latest trip."""
    docs = joins.fan_in(
        parts["ticket_doc"],
        [
            event_flags(parts["ticket_event"]),
            rollups.sums(parts["ticket_payment"], "access_key", {"paid": "paid_sum"}),
            latest_trip(parts["ticket_trip"]),
            rollups.sums(parts["ticket_component"], "access_key", {"amount": "component_sum"}),
        ],
        ["access_key"],
    )
    return docs.withColumns(
        {
            "cancelled": F.coalesce("cancelled", F.lit(False)),
            "not_boarded": F.coalesce("not_boarded", F.lit(False)),
            "emitted_at": dates.from_epoch("emitted"),
            "total": F.coalesce("paid", "listed").cast("decimal(17,2)"),
            "op_code": F.lpad(codes.digits_only("op_code"), 4, "0"),
        }
    )


def items_of(docs: DataFrame, detail: DataFrame) -> DataFrame:
    """Detail rows as items; a ticket without detail becomes one item of its own."""
    own = number_items(detail).select(
        "access_key", F.col("item_no").cast("int"), F.lpad(codes.digits_only("op_code"), 4, "0").alias("own_code"),
        F.coalesce("listed", "taxed").cast("decimal(17,2)").alias("own_value"),
    )
    joined = docs.select("access_key", "op_code", "total").join(own, "access_key", "left")
    none = F.col("item_no").isNull()
    return joined.select(
        "access_key",
        F.coalesce("item_no", F.lit(1)).alias("item_no"),
        F.coalesce("own_code", "op_code").alias("op_code"),
        F.when(none, F.col("total")).otherwise(F.col("own_value")).alias("value"),
    )


def run(parts: dict[str, DataFrame], ref: References, run_id: int) -> tuple[DataFrame, DataFrame]:
    docs = prepare(parts)
    items = chain.flag_codes(items_of(docs, parts["ticket_detail"]), ref.op_codes, "op_code", "code_participates")
    items = items.withColumns(
        {
            "value_added": rules.value_or_zero("value", "code_participates"),
            "gross": F.col("value"), "product_participates": F.lit(False),
            "item_doc_type": F.lit(None).cast("int"),
        }
    )
    docs = joins.fan_in(docs.drop("op_code"), [rollups.item_rollup(items, "access_key").drop("doc_type")], ["access_key"])
    reason = rules.ticket_reason("cancelled", "not_boarded")
    counts = F.col("code_participates") & reason.isNull()
    docs = docs.withColumns(
        {
            "reason": reason,
            "appropriation": F.when(counts, "S").otherwise("N"),
            "value_added": F.when(counts, F.col("value_added")).otherwise(rules.amount(None)),
            "exit_state": F.col("state"), "exit_muni": F.col("muni"),
        }
    )
    return chain.project_documents(docs, K.TICKET, run_id), chain.project_items(items, K.TICKET, run_id)
