"""Goods and consumer invoices: sections to documents and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, dates, rules
from apportia.operators import joins, rollups
from apportia.plans import rules as chain
from apportia.plans.references import References
from apportia.sources import tables


def prepare_documents(parts: dict[str, DataFrame], model: str, home: str = K.HOME_STATE) -> DataFrame:
    """Header with issuer, recipient and totals; only documents with a side in the home state."""
    header = parts["goods_header"].where((F.col("model") == model) & (F.col("environment") == "1"))
    party = lambda df, side: df.select(
        "access_key", codes.registration("reg").alias(f"{side}_reg"),
        F.upper(F.trim("state")).alias(f"{side}_state"), codes.muni_number("muni", 7).alias(f"{side}_own_muni"),
    )
    docs = joins.fan_in(
        header,
        [
            party(parts["goods_issuer"], "exit"), party(parts["goods_recipient"], "entry"),
            parts["goods_total"].select("access_key", F.col("total").cast("decimal(17,2)")),
        ],
        ["access_key"],
    )
    header_state = codes.state_of("state_code")
    docs = docs.withColumns(
        {
            "emitted_at": dates.from_epoch("emitted"),
            "exit_tax_no": codes.padded_tax_number(codes.tax_number("issuer_company", "issuer_person")),
            "entry_tax_no": codes.padded_tax_number(codes.tax_number("recipient_company", "recipient_person")),
            "home_side": rules.home_side("exit_state", "entry_state", header_state, home),
            "entry_muni": F.coalesce("entry_own_muni", "muni"),
            "exit_muni": F.coalesce("exit_own_muni", "muni"),
        }
    )
    return docs.where(F.col("home_side").isNotNull())


def prepare_items(parts: dict[str, DataFrame]) -> DataFrame:
    """Items with their tax sections, tax sums, waiver source and item value."""
    on = ["access_key", "item_no"]
    drop = lambda df: df.drop("emitted")
    taxes = parts["goods_item_tax"]
    zero = lambda *c: rules.total(*c).cast("decimal(15,2)")
    tax = taxes.select(
        *on,
        zero("st_10", "st_30", "st_70", "st_90").alias("substituted_tax"),
        zero("mono_02", "mono_15", "mono_15_retained", "mono_53").alias("single_phase_tax"),
        zero("waiver").alias("waiver"),
        rules.waiver_source(
            {"ICMS40_41_50": "why_40", "ICMS30": "why_30", "ICMS70": "why_70", "ICMS90": "why_90", "ICMS20": "why_20"}
        ).alias("waiver_source"),
    )
    items = joins.fan_in(
        drop(parts["goods_item"]),
        [tax, drop(parts["goods_item_ipi"]), drop(parts["goods_item_import"]), drop(parts["goods_item_fuel"])],
        on,
    )
    value = rules.item_value(
        "gross", "freight", "insurance", "other", "ipi", "substituted_tax", "discount", "waiver",
        "import_tax", "given_value",
    )
    return items.withColumn("value", value)


SECTIONS = (
    "goods_header", "goods_issuer", "goods_recipient", "goods_total", "goods_item", "goods_item_tax",
    "goods_item_ipi", "goods_item_import", "goods_item_fuel",
)


def run(
    parts: dict[str, DataFrame], ref: References, registry: DataFrame, run_id: int, model: str = "55",
    home: str = K.HOME_STATE, window: tuple[str, str] | None = None, store=lambda df: df, received: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(documents, items) in the unified layout, participating documents only; ``received``: those issued elsewhere.

    Items are flagged and rolled up before the documents are joined. ``registry`` must have no
    overlapping versions (``joins.without_overlaps``). ``store`` may materialise flagged items and
    documents, which both results need, so that they are computed once.
    """
    items = store(chain.apply_to_items(prepare_items(parts), ref).withColumn(
        "item_doc_type", F.lit(None).cast("int")
    ))
    if received:
        parts = parts | {"goods_header": parts["goods_header"].where(~codes.issued_at_home("access_key"))}
    docs = chain.apply_to_documents(prepare_documents(parts, model, home), ref)
    docs = joins.fan_in(docs, [rollups.item_rollup(items, "access_key")], ["access_key"])
    docs = docs.withColumns(
        {
            "code_participates": F.coalesce("code_participates", F.lit(False)),
            "product_participates": F.coalesce("product_participates", F.lit(False)),
            "value_added": rules.amount("value_added"),
        }
    )
    for side in ("entry", "exit"):
        docs = attach_registry(docs, registry, side, window)
    rural = F.coalesce(F.col("entry_rural"), F.lit(False)) | F.coalesce(F.col("exit_rural"), F.lit(False))
    docs = docs.withColumn(
        "reason",
        rules.document_reason(
            "cancelled", "substituted", "code_participates", F.col("product_participates") & rural
        ),
    )
    docs = docs.withColumn("appropriation", side_appropriation())
    kept = docs.where(F.col("reason").isNull())
    doc_type = K.RECEIVED_INVOICE if received else K.ISSUED_INVOICE if model == "55" else K.CONSUMER_INVOICE
    documents = store(chain.project_documents(kept, doc_type, run_id))
    items_kept = joins.keep_matching(items, documents, ["access_key"])
    return documents, chain.project_items(items_kept, doc_type, run_id)


def attach_registry(
    docs: DataFrame, registry: DataFrame, side: str, window: tuple[str, str] | None
) -> DataFrame:
    """Registry attributes in force at emission, prefixed by the side."""
    return joins.as_of(
        docs, registry, {f"{side}_state": "state", f"{side}_reg": "reg"}, "emitted_at", "valid_from", "valid_to",
        {"status": f"{side}_status", "regime": f"{side}_regime", "rural": f"{side}_rural"}, ["muni"],
        window, disjoint=True,
    )


def side_appropriation():
    return rules.appropriation(
        ("entry_status", "entry_regime", "entry_rural"), ("exit_status", "exit_regime", "exit_rural")
    )


def load(
    spark: SparkSession, catalog: tables.Catalog, ref: References, registry: DataFrame, run_id: int,
    window: tuple[str, str], key: str | None = None, where: str | None = None, model: str = "55",
    home: str = K.HOME_STATE, store=lambda df: df, received: bool = False,
) -> tuple[DataFrame, DataFrame]:
    parts = {n: tables.read_section(spark, catalog, n, window, key, where) for n in SECTIONS}
    live = joins.without_overlaps(registry, ["state", "reg"], "valid_from", "valid_to", ["muni"])
    return run(parts, ref, store(live), run_id, model, home, window, store, received)
