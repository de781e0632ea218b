"""Corrections of stored documents and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, rules
from apportia.operators import history, joins, pairs, rollups, sinks, spans, versions
from apportia.session import cut_lineage

DOC = ["access_key", "doc_type"]


def op_codes_changed(
    docs: DataFrame, items: DataFrame, op_codes: DataFrame, within: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(documents, items) after the list of participating codes changed.

    Documents excluded as cancelled or for both parties stay as they are, and those that ``within``, if given,
    does not list; the others are rolled up again. Earlier reasons 1 and 12 are recomputed, other item reasons stay.
    """
    fixed = F.col("reason").isin(K.CANCELLED, K.PARTIES_OUT)
    open_docs = docs.where(~F.coalesce(fixed, F.lit(False)))
    if within is not None:
        open_docs = joins.keep_matching(open_docs.select(*DOC), within, DOC)
    mine = joins.keep_matching(items, open_docs, DOC)
    flagged = joins.participation_flag(mine, op_codes, "op_code", "code", "code_participates")
    settled = rollups.settle(rollups.participation_split(flagged, DOC), [])
    changes = settled.select(*DOC, F.col("value_in").alias("value_added"), "reason")
    new_docs = sinks.update_columns(docs, changes, DOC, ["value_added", "reason"])
    reason = F.when(~F.col("code_participates"), K.OP_CODE_OUT).when(
        F.col("reason") != K.OP_CODE_OUT, F.col("reason")
    )
    # Items are dealt once, by document; rows of one line number take the greatest reason, those without one stay.
    keys = open_docs.select(*DOC).distinct().withColumn("__open", F.lit(True))
    marked = items.join(keys.hint("merge"), DOC, "left")
    marked = joins.participation_flag(marked, op_codes, "op_code", "code", "code_participates")
    greatest = F.max(F.struct(reason.cast("int").alias("reason"))).over(Window.partitionBy(*DOC, "item_no"))
    again = F.when(F.col("__open") & F.col("item_no").isNotNull(), greatest["reason"]).otherwise(F.col("reason"))
    return new_docs, marked.select(*[again.alias(c) if c == "reason" else F.col(c) for c in items.columns])


#: Reasons that the roll-up of the items gives; any other is kept with its value.
ROLLED_UP = (K.OP_CODE_OUT, K.CANCELLED, K.PARTIES_OUT, K.NO_ITEM_LEFT)


def registry_changed(
    docs: DataFrame, items: DataFrame, op_codes: DataFrame, registry: DataFrame, start: str = "valid_from",
    stop: str = "valid_to", window: tuple[str, str] | None = None, keys: list[str] = DOC, store=cut_lineage,
) -> DataFrame:
    """Documents with registry rows, appropriation, value and reason taken again at emission time.

    The items are rolled up again, since a document that was excluded for its parties has no value stored;
    one whose parties are now excluded loses it. Cancelled documents stay cancelled; documents with a
    reason that does not come from the roll-up keep it with their value, unless both parties are out.
    One as-of join per side serves all days and types.
    """
    live = store(joins.without_overlaps(registry, ["state", "reg"], start, stop, ["muni"]))
    return taken_again(docs, items, op_codes, live, start, stop, window, keys)


def taken_again(docs, items, op_codes, live, start, stop, window=None, keys=DOC) -> DataFrame:
    """``registry_changed`` with a registry that has no overlaps."""
    flagged = joins.participation_flag(items, op_codes, "op_code", "code", "code_participates")
    split = rollups.participation_split(flagged, keys)
    out = docs.join(split, keys, "left").withColumns(
        {v: F.coalesce(v, F.lit(0).cast("decimal(17,2)")) for v in ("value_in", "value_out")}
    )
    for side in ("entry", "exit"):
        out = joins.as_of(
            out, live, {f"{side}_state": "state", f"{side}_reg": "reg"}, "emitted_at", start, stop,
            {
                "id": f"{side}_id", "status": f"{side}_status", "regime": f"{side}_regime",
                "rural": f"{side}_rural",
            },
            ["muni"], window, disjoint=True,
        )
    sides = [(f"{s}_status", f"{s}_regime", f"{s}_rural") for s in ("entry", "exit")]
    both = F.coalesce(rules.both_parties_out(sides[0][:2], sides[1][:2]), F.lit(False))
    marked = out.withColumns(
        {
            "appropriation": rules.appropriation(*sides), "__value": F.col("value_added"), "__old": F.col("reason"),
            "__kept": ~both & F.col("reason").isNotNull() & ~F.col("reason").isin(*ROLLED_UP), "__both": both,
        }
    )
    settled = rollups.settle(
        marked.drop("reason"), [(F.col("__old") == K.CANCELLED, K.CANCELLED), (F.col("__both"), K.PARTIES_OUT)]
    )
    return settled.withColumns(
        {
            "value_added": F.when(F.col("__kept"), F.col("__value")).otherwise(F.col("value_in")).cast("decimal(17,2)"),
            "reason": F.when(F.col("__kept"), F.col("__old")).otherwise(F.col("reason")).cast("int"),
        }
    ).drop("__value", "__old", "__kept", "__both", "value_in", "value_out")


#: What the registry gives to a stored document.
TAKEN = tuple(f"{side}_{c}" for side in ("entry", "exit") for c in ("id", "status", "regime", "rural")) + ("appropriation",)


def registry_reworked(
    docs: DataFrame, items: DataFrame, op_codes: DataFrame, old: DataFrame, registry: DataFrame, start: str = "valid_from",
    stop: str = "valid_to", window: tuple[str, str] | None = None, keys: list[str] = DOC, store=cut_lineage,
) -> tuple[DataFrame, DataFrame]:
    """(documents, keys of those taken again) after the registry changed from ``old``.

    ``docs`` are stored with what ``old`` gave them (``TAKEN``). The two registries give for each party the spans
    in which its version differs; only documents one of whose parties has such a span at their emission, and
    only their items, go through ``registry_changed``. The result is what that gives for all.
    """
    before, live = (store(joins.without_overlaps(r, ["state", "reg"], start, stop, ["muni"])) for r in (old, registry))
    changed = store(versions.changed_spans(before, live, ["state", "reg"], start, stop, ["id", "status", "regime", "rural"]))
    marked = docs
    for side in ("entry", "exit"):
        marked = joins.as_of(
            marked, changed.withColumn("hit", F.lit(True)), {f"{side}_state": "state", f"{side}_reg": "reg"}, "emitted_at", start, stop,
            {"hit": f"__{side}_hit"}, [], window, disjoint=True,
        )
    marked = store(marked.withColumn("__hit", F.coalesce("__entry_hit", "__exit_hit", F.lit(False))))
    touched = marked.where("__hit").select(*[c for c in docs.columns if c not in TAKEN])
    again = taken_again(touched, joins.keep_matching(items, touched, keys), op_codes, live, start, stop, window, keys)
    rest = marked.where("NOT __hit").select(*docs.columns)
    return rest.unionByName(again.select(*docs.columns)), touched.select(*keys)


def op_codes_reworked(
    docs: DataFrame, items: DataFrame, old: DataFrame, op_codes: DataFrame, store=cut_lineage
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, items, keys of the documents taken again) after the list of operation codes changed from ``old``.

    ``docs`` and ``items`` are stored as ``old`` settled them. A document without an item of a code that came or
    went is settled already; the others go through ``op_codes_changed``, which gives the same for all.
    """
    one = lambda codes_, name: codes_.select("code").distinct().withColumn(name, F.lit(True))
    moved = one(old, "was").join(one(op_codes, "is"), "code", "full").where("was IS NULL OR is IS NULL")
    # The codes that moved are sent to all tasks: dealt by code, the items of a frequent one would meet in one task.
    moved = F.broadcast(moved.select(F.col("code").alias("op_code")).distinct())
    hit = store(items.join(moved, "op_code", "left_semi").select(*DOC).distinct())
    return *op_codes_changed(docs, items, op_codes, hit), hit


def cancel_invoices(docs: DataFrame, keys: DataFrame, home_code: str = "52") -> DataFrame:
    """Listed invoices lose their value and get reason 10.

    Keys of the home state are issued invoices, others received ones; rows already cancelled stay.
    """
    listed = keys.select(
        "access_key",
        F.when(codes.issued_at_home("access_key", home_code), K.ISSUED_INVOICE)
        .otherwise(K.RECEIVED_INVOICE).alias("doc_type"),
    ).distinct()
    zero = F.lit(0).cast("decimal(17,2)")
    changes = listed.withColumns({"value_added": zero, "reason": F.lit(K.CANCELLED)})
    return sinks.update_columns(docs, changes, DOC, ["value_added", "reason"])


def refresh_consumption_class(key_map: DataFrame, bills: DataFrame) -> DataFrame:
    """Consumption class of each bill taken from the source again."""
    fresh = spans.best_row(bills.select("access_key", "consumption_class"), ["access_key"], ["consumption_class"])
    return sinks.update_columns(key_map, fresh, ["access_key"], ["consumption_class"])


def duplicate_operations(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, items) with operations between two taxpayers that undo each other excluded.

    ``docs`` has DOC keys, both parties, value_added and reason; ``items`` has op_code,
    product_code, gross, value_added and reason. Bidirectional pairs are found first, so only
    their items are totalled.
    """
    open_docs = docs.where(
        F.col("reason").isNull()
        & F.col("doc_type").isin(K.ISSUED_INVOICE, K.RECEIVED_INVOICE, K.LOOSE_INVOICE)
    ).select(*DOC, *pairs.PAIR)
    both = pairs.bidirectional_pairs(open_docs)
    chosen = pairs.between_listed_pairs(open_docs, both)
    rows = items.where(F.col("reason").isNull() & rules.mirrored_op_code("op_code").isNotNull())
    rows = rows.join(chosen, DOC).withColumn("product", F.substring("product_code", 1, 4))
    excluded = pairs.opposite_operations(pairs.operation_totals(rows))
    flagged, doc_changes = pairs.exclude_opposite(rows, excluded, DOC)
    item_changes = flagged.where("duplicate").select(
        *DOC, "item_no", F.lit(K.DUPLICATE_OPERATION).alias("reason")
    )
    value = doc_changes.withColumn("value_added", F.col("value_added").cast("decimal(17,2)"))
    return (
        sinks.update_columns(docs, value, DOC, ["value_added", "reason"]),
        sinks.update_columns(items, item_changes, [*DOC, "item_no"], ["reason"]),
    )


def fixed_asset_exclusion(
    docs: DataFrame, items: DataFrame, matches: DataFrame, invoice_items: DataFrame, ledger_items: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """(documents, items) after invoice items also booked in the ledger are excluded.

    ``matches`` comes from ``pairs.match_by_key``; item frames have doc_id, doc_type, item_no.
    """
    side = lambda df, s: df.select(
        F.col("doc_id").alias(f"{s}_id"), F.col("doc_type").alias(f"{s}_type"), "item_no"
    )
    left = matches.join(side(invoice_items, "invoice"), ["invoice_id", "invoice_type"])
    right = matches.join(side(ledger_items, "ledger"), ["ledger_id", "ledger_type"])
    matched = pairs.positional_match(
        left.select(*pairs.MATCH, "item_no"), right.select(*pairs.MATCH, "item_no"), pairs.MATCH,
        ["item_no"], spans.number_span("item_no"),
    )
    hit_items, hit_docs = pairs.fixed_assets(matched, ["invoice_id", "invoice_type"], "item_no")
    named = lambda df: df.withColumnsRenamed({"invoice_id": "access_key", "invoice_type": "doc_type"})
    return (
        sinks.update_columns(docs, named(hit_docs), DOC, ["value_added", "reason"]),
        sinks.update_columns(items, named(hit_items), [*DOC, "item_no"], ["reason"]),
    )


REGISTRY_KEYS = ["reg", "state", "valid_from"]
REGISTRY_VALUES = ["valid_to", "status", "regime", "muni", "rural", "rural_only"]


def rebuild_registry(
    stored: DataFrame, current: DataFrame, log: DataFrame, now: str, state: str = K.HOME_STATE
) -> tuple[DataFrame, DataFrame]:
    """(difference, registry after it) from a replay of the change log.

    ``current`` has reg, status, regime, muni (text) and the tallies of activities held
    (activities, rural_activities); ``log`` the columns ``history.replay`` takes.
    """
    attrs, counts = ["status", "regime", "muni"], ["activities", "rural_activities"]
    versions_ = history.replay(current, log, "reg", "at", attrs, now, counts)
    rural = F.col("rural_activities") > 0
    flat = versions_.select(
        "reg", "at", *attrs,
        rural.alias("rural"),
        (rural & (F.col("rural_activities") >= F.col("activities"))).alias("rural_only"),
    )
    fresh = history.daily_versions(
        flat, ["reg"], "at", [*attrs, "rural", "rural_only"], "valid_from", "valid_to"
    ).withColumns({"state": F.lit(state), "muni": F.col("muni").try_cast("int")})
    mine = stored.where(F.col("state") == state)
    diff = versions.difference(mine, fresh, REGISTRY_KEYS, REGISTRY_VALUES)
    rows = stored.select(*REGISTRY_KEYS, *REGISTRY_VALUES)
    return diff, versions.apply_difference(rows, diff, REGISTRY_KEYS)
