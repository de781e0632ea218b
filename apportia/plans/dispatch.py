"""One entry point for the document loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia import constants as K
from apportia import schemas
from apportia.functions import dates
from apportia.operators import commits, joins, sinks
from apportia.plans import energy, goods, ledger, loose, references, telecom, ticket, transport
from apportia.plans.store import PARTITIONS
from apportia.session import cut_lineage
from apportia.sources import tables

DOC_TYPE = {
    "goods": K.ISSUED_INVOICE, "consumer": K.CONSUMER_INVOICE, "transport": K.TRANSPORT, "energy": K.ENERGY,
    "ticket": K.TICKET, "ledger": K.LEDGER, "received": K.RECEIVED_INVOICE, "loose": K.LOOSE_INVOICE, "telecom": K.TELECOM,
}


def prepare(
    spark: SparkSession, kind: str, catalog: tables.Catalog, window: tuple[str, str], run_id: int,
    registry: DataFrame | None = None, key: str | None = None, where: str | None = None,
    home: str = K.HOME_STATE, store=lambda df: df,
) -> tuple[DataFrame, DataFrame | None]:
    """(documents, items) of a kind for a whole window; a window of many days is one job."""
    read = lambda name: tables.read_section(spark, catalog, name, window, key, where)
    if kind in ("goods", "consumer", "received"):
        ref = references.load(spark, catalog)
        model = "65" if kind == "consumer" else "55"
        return goods.load(spark, catalog, ref, registry, run_id, window, key, where, model, home, store, kind == "received")
    if kind == "loose":
        live = store(joins.without_overlaps(registry, ["state", "reg"], "valid_from", "valid_to", ["muni"]))
        return loose.load(read("loose_note"), read("loose_party"), live, run_id, window), None
    if kind == "telecom":
        return telecom.load(read("telecom_doc"), read("telecom_item"), references.load(spark, catalog), run_id)
    if kind == "transport":
        names = ("transport_doc", "transport_value", "transport_event")
        return transport.run({n: read(n) for n in names}, run_id, home), None
    if kind == "energy":
        totals = [read(n) for n in schemas.ENERGY_TOTALS if n in catalog] or [read("energy_total")]
        return energy.run(read("energy_doc"), totals, read("energy_event"), run_id, home), None
    if kind == "ticket":
        names = ("ticket_doc", "ticket_event", "ticket_detail", "ticket_trip", "ticket_payment", "ticket_component")
        return ticket.run({n: read(n) for n in names}, references.load(spark, catalog), run_id)
    if kind == "ledger":
        ref = references.load(spark, catalog)
        return ledger.run(read("ledger_document"), read("ledger_item"), read("ledger_period"), ref, run_id)
    raise ValueError(f"unknown kind {kind!r}")


def load(
    spark: SparkSession, kind: str, catalog: tables.Catalog, window: tuple[str, str], run_id: int,
    documents_path: str, items_path: str, registry: DataFrame | None = None, home: str = K.HOME_STATE,
) -> dict[str, int]:
    """Load a window and put its documents and items in the place of those stored for it.

    The window may be any span of time: documents emitted in it, of this type, go with their items, also
    if the load yields none; the rest of a month stays. Returns the rows put in.
    """
    documents, items = prepare(spark, kind, catalog, window, run_id, registry, home=home, store=cut_lineage)
    documents = cut_lineage(documents)
    inside = dates.between("emitted_at", *window) & (F.col("doc_type") == DOC_TYPE[kind])
    periods = [int(w[:4]) * 100 + int(w[5:7]) for w in window]
    touched = (F.col("doc_type") == DOC_TYPE[kind]) & F.col("period").between(*periods)
    placed = documents.select("access_key", "period").distinct()
    keys = placed.select("access_key")
    old = sinks.stored_rows(spark, documents_path)
    if old is not None:
        keys = keys.unionByName(old.where(touched & inside).select("access_key")).distinct()
    keys = cut_lineage(keys)
    counts = {"documents": sinks.replace_rows(spark, documents, documents_path, PARTITIONS, touched, inside)}
    if items is not None:
        rows = items.join(placed, "access_key")
        counts["items"] = sinks.replace_rows(spark, rows, items_path, PARTITIONS, touched, keys, ["access_key"])
    return counts


def load_committed(
    spark: SparkSession, kind: str, catalog: tables.Catalog, window: tuple[str, str], run_id: int, store: commits.Tables,
    registry: DataFrame | None = None, home: str = K.HOME_STATE, base: commits.State | None = None,
    marks: dict[str, str] | None = None,
) -> dict[str, int]:
    """``load`` as one commit: documents, items and marks change together, and a load that stops changes nothing.

    ``store`` is partitioned like ``store.PARTITIONS``. Raises ``commits.Conflict`` if another load has
    committed since ``base``, the state now by default.
    """
    base = base or store.state()
    documents, items = prepare(spark, kind, catalog, window, run_id, registry, home=home, store=cut_lineage)
    documents = cut_lineage(documents)
    inside = dates.between("emitted_at", *window) & (F.col("doc_type") == DOC_TYPE[kind])
    first, last = (int(w[:4]) * 100 + int(w[5:7]) for w in window)
    touched = lambda values: values[0] == DOC_TYPE[kind] and first <= values[1] <= last
    changes = {"documents": commits.replaced_rows(store, base, "documents", documents, touched, inside)}
    counts = {"documents": documents.count()}
    if items is not None:
        placed = documents.select("access_key", *[c for c in PARTITIONS if c not in items.columns]).distinct()
        rows = cut_lineage(items.join(placed, "access_key"))
        keys = placed.select("access_key")
        old = store.read("documents", base, touched)
        if old is not None:
            keys = keys.unionByName(old.where(inside).select("access_key")).distinct()
        changes["items"] = commits.replaced_rows(store, base, "items", rows, touched, keys, ["access_key"])
        counts["items"] = rows.count()
    changes = {n: commits.Change(cut_lineage(c.rows), c.replaced) for n, c in changes.items()}
    store.commit(base, changes, marks)
    return counts
