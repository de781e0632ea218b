"""Listings of participating and excluded documents and items."""

from __future__ import annotations

from calendar import monthrange

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.functions import rules
from apportia.session import cut_lineage


def scope(
    doc_type: int | None = None, periods: tuple[int, int] | None = None, reg: int | None = None,
    access_key: str | None = None,
) -> Column:
    """Optional restrictions, joined by and; a registration may be on either side."""
    out = F.lit(True)
    if doc_type is not None:
        out = out & (F.col("doc_type") == doc_type)
    if periods:
        out = out & F.col("period").between(*periods)
    if reg is not None:
        out = out & ((F.col("entry_reg") == reg) | (F.col("exit_reg") == reg))
    if access_key is not None:
        out = out & (F.col("access_key") == access_key)
    return out


def participating(docs: DataFrame, items: DataFrame, registry: DataFrame, within: Column) -> DataFrame:
    """Documents with items, taxpayer classes of both sides and readable labels.

    The restriction applies to the documents before any join.
    """
    d = docs.where(within & F.col("reason").isNull())
    r = registry.select("id", rules.taxpayer_class("rural", "status", "regime").alias("class"))
    for side in ("exit", "entry"):
        d = d.join(
            r.select(F.col("id").alias(f"{side}_id"), F.col("class").alias(f"{side}_class")),
            f"{side}_id", "left",
        )
    d = d.withColumns(
        {
            "issued": F.date_format("emitted_at", "dd/MM/yyyy HH:mm:ss"),
            "appropriation_label": rules.appropriation_label("appropriation"),
        }
    )
    i = items.select("access_key", "doc_type", "item_no", "op_code", "product_code", "gross",
                     F.col("value_added").alias("item_value"))
    return d.join(i, ["access_key", "doc_type"])


def excluded_documents(docs: DataFrame, within: Column) -> DataFrame:
    return docs.where(within & F.col("reason").isNotNull()).withColumn("reason_text", rules.reason_text("reason"))


def excluded_items(docs: DataFrame, items: DataFrame, within: Column) -> DataFrame:
    """Excluded items of the documents in scope, with the reason in words."""
    keys = docs.where(within).select("access_key", "doc_type", "period", "entry_reg", "exit_reg")
    bad = items.where(F.col("reason").isNotNull()).withColumn("reason_text", rules.reason_text("reason"))
    return bad.join(keys, ["access_key", "doc_type"])


def listing(df: DataFrame, within: Column, order: list[str]) -> DataFrame:
    return df.where(within).orderBy(*order)


def regime_study(
    docs: DataFrame, items: DataFrame, options: DataFrame, registry: DataFrame, munis: DataFrame,
    side: str, op_codes: tuple[int, ...], periods: tuple[int, int], muni: int, store=cut_lineage,
) -> DataFrame:
    """Item value of simplified-regime taxpayers of one municipality, exit or entry side.

    The option period and the registry row are those at emission; a party without registry row
    counts as simplified, one in a normal regime does not. Items are summed per document first, and the
    registry is freed of overlaps once, stored, and met by year of the periods.
    """
    from apportia import constants as K
    from apportia.operators import joins

    d = docs.where(
        F.col("period").between(*periods) & F.col("doc_type").isin(K.CONSUMER_INVOICE, K.ISSUED_INVOICE)
        & (F.col("reason").isNull() | (F.col("reason") != K.CANCELLED))
        & (F.col("direction") == (1 if side == "exit" else 0))
        & (F.length("tax_no") > 11)
    ).drop("value_added").withColumn("base", F.substring("tax_no", 1, 8))
    value = (
        items.where(F.col("reason").isNull() & F.col("op_code").cast("int").isin(*op_codes))
        .groupBy("access_key", "doc_type").agg(F.sum("value_added").alias("value_added"))
    )
    out = joins.in_option_period(d, options, "base", "emitted_at", {"reg": "option_reg"})
    out = out.where(F.col("option_reg").isNotNull())
    live = store(joins.without_overlaps(registry, ["state", "reg"], "valid_from", "valid_to", ["muni"]))
    year, month = divmod(periods[1], 100)
    window = (
        f"{periods[0] // 100}-{periods[0] % 100:02d}-01 00:00:00", f"{year}-{month:02d}-{monthrange(year, month)[1]} 23:59:59.999999"
    )
    out = joins.as_of(
        out.withColumn("__state", F.lit(K.HOME_STATE)), live, {"__state": "state", "party_reg": "reg"},
        "emitted_at", "valid_from", "valid_to",
        {"reg": "known_reg", "muni": "known_muni", "regime": "regime"}, ["muni"], window, disjoint=True,
    ).drop("__state")
    m = munis.select(F.col("federal_code").alias("federal_code"), F.col("muni").alias("doc_muni"))
    out = out.join(m, "federal_code")
    out = out.where(
        (F.coalesce(F.col("regime").cast("int"), F.lit(3)) >= 3)
        & ((F.col("known_muni") == muni) | (F.col("doc_muni") == muni))
    )
    return (
        out.join(value, ["access_key", "doc_type"])
        .groupBy(
            "direction", "access_key", "period", "tax_no", "party_reg", "doc_muni",
            F.coalesce("known_reg", F.lit(0)).alias("known_reg"),
            F.coalesce("known_muni", F.lit(0)).alias("known_muni"),
            F.coalesce("option_reg", F.lit(0)).alias("option_reg"),
        )
        .agg(F.sum("value_added").alias("value_added"))
    )
