"""Loose invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, rules

ISSUER, RECIPIENT = 2, 3


def roles(parties: DataFrame) -> DataFrame:
    """Issuer and recipient of a note side by side, from one row per party role.

    One pass groups the party rows by note, instead of joining the table with itself.
    """
    pick = lambda role, c: F.max_by(F.col(c), F.when(F.col("role") == role, F.struct("reg", "muni", "state")))
    return parties.where(F.col("role").isin(ISSUER, RECIPIENT)).groupBy("note_id").agg(
        *[pick(ISSUER, c).alias(f"issuer_{c}") for c in ("reg", "muni", "state")],
        *[pick(RECIPIENT, c).alias(f"recipient_{c}") for c in ("reg", "muni", "state")],
    )


def project(docs: DataFrame, notes: DataFrame, parties: DataFrame, registry: DataFrame) -> DataFrame:
    """Documents with roles, taxpayer classes by reference month, labels, year and month."""
    r = registry.select(
        "reg", "period", rules.taxpayer_class("rural", "status", "regime").alias("class")
    )
    side = lambda s: r.select(
        F.col("reg").alias(f"{s}_reg"), "period", F.col("class").alias(f"{s}_class")
    )
    out = docs.join(notes, "note_id").join(roles(parties), "note_id", "left")
    for s in ("exit", "entry"):
        out = out.join(side(s), [f"{s}_reg", "period"], "left")
    return out.withColumns(
        {
            "operation_label": F.when(F.col("note_kind") == 1, "Entry").otherwise("Exit"),
            "destination_label": rules.loose_destination_label("operation"),
            "purpose_label": rules.loose_purpose_label("operation"),
            "year": F.year("emitted_at"), "month": F.month("emitted_at"),
        }
    )


def settle(docs: DataFrame) -> DataFrame:
    """Reasons 10 and 11 only, the latter last; no item roll-up."""
    out = F.when(
        rules.both_parties_out(("entry_status", "entry_regime"), ("exit_status", "exit_regime")), K.PARTIES_OUT
    ).when(F.coalesce(F.col("note_status") != "NORMAL", F.lit(True)), K.CANCELLED)
    return docs.withColumn("reason", out.cast("int"))


def run(docs: DataFrame, run_id: int) -> DataFrame:
    from apportia.plans import goods
    from apportia.plans import rules as chain

    settled = settle(docs.withColumn("appropriation", goods.side_appropriation()))
    return chain.project_documents(settled, K.LOOSE_INVOICE, run_id)


def load(
    notes: DataFrame, parties: DataFrame, registry: DataFrame, run_id: int, window: tuple[str, str] | None = None
) -> DataFrame:
    """Documents of notes and their party rows: the issuer is the exit side, the recipient the entry side.

    ``registry`` has no overlapping versions.
    """
    from apportia.plans import goods

    docs = notes.join(roles(parties), "note_id", "left").withColumn("emitted_at", F.col("emitted"))
    for side, role in (("exit", "issuer"), ("entry", "recipient")):
        docs = docs.withColumns({
            f"{side}_reg": codes.registration(f"{role}_reg"), f"{side}_muni": codes.muni_number(f"{role}_muni", 7),
            f"{side}_state": F.upper(F.trim(f"{role}_state")),
        })
        docs = goods.attach_registry(docs, registry, side, window)
    return run(docs.withColumn("value_added", rules.amount("value")), run_id)
