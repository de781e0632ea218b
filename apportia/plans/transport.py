"""Transport documents: header, values and events to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, rules
from apportia.operators import joins, rollups
from apportia.plans import rules as chain


def values(df: DataFrame) -> DataFrame:
    """One row per key; the discount is what was charged but not received."""
    one = rollups.first_known([df.select("access_key", "charged", "received")], "access_key", ["charged", "received"])
    return one.withColumn("discount", rules.transport_discount("charged", "received"))


def prepare(parts: dict[str, DataFrame], home: str = K.HOME_STATE, model: str = "57") -> DataFrame:
    """Production documents of the model with a home side, values and event flags."""
    head = parts["transport_doc"].where((F.col("model") == model) & (F.col("environment") == "1"))
    events = rollups.coded_events(
        parts["transport_event"], "access_key", "kind", K.TRANSPORT_SUBSTITUTE, K.TRANSPORT_VOID
    )
    docs = joins.fan_in(head, [values(parts["transport_value"])], ["access_key"])
    docs = joins.mark_events(docs, events, "access_key")
    issuer = F.upper(F.trim("issuer_state"))
    taker = F.upper(F.trim("taker_state"))
    docs = docs.withColumns(
        {
            "emitted_at": F.col("emitted"),
            "exit_state": issuer, "entry_state": taker,
            "exit_reg": codes.registration("issuer_reg"), "entry_reg": codes.registration("taker_reg"),
            "exit_muni": codes.muni_number("issuer_muni", 7), "entry_muni": codes.muni_number("taker_muni", 7),
            "home_side": rules.home_side(issuer, taker, codes.state_of("state_code"), home),
        }
    )
    return docs.where(F.col("home_side").isNotNull())


def run(parts: dict[str, DataFrame], run_id: int, home: str = K.HOME_STATE) -> DataFrame:
    """All documents; excluded ones have no value and their reason."""
    docs = prepare(parts, home)
    reason = rules.document_reason("cancelled", "substituted")
    docs = docs.withColumn("reason", reason).withColumns(
        {
            "total": F.col("charged"),
            "value_added": F.when(F.col("reason").isNull(), rules.amount("charged")).otherwise(rules.amount(None)),
            "appropriation": F.when(F.col("reason").isNull(), "S").otherwise("N"),
        }
    )
    return chain.project_documents(docs, K.TRANSPORT, run_id)


def settle(docs: DataFrame, key: str = "access_key") -> DataFrame:
    """Participation of the relational load: code, annulled, substituted, value below receivable."""
    annulled = F.coalesce(F.col("annulment_key"), F.lit("0")) != "0"
    replaced = F.coalesce(F.col("substitute_key"), F.lit("0")) != "0"
    short = F.col("value_added") < F.col("received")
    split = rollups.participation_split(docs, key)
    flags = docs.groupBy(key).agg(
        F.bool_or(annulled).alias("annulled"), F.bool_or(replaced).alias("replaced"),
        F.bool_or(F.coalesce(short, F.lit(False))).alias("short"),
    )
    joined = split.join(flags, key)
    return rollups.settle(
        joined,
        [
            (F.col("annulled"), K.CANCELLED), (F.col("replaced"), K.SUBSTITUTED),
            (F.col("short"), K.INCONSISTENT_VALUES),
        ],
    )
