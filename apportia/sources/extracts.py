"""Item-level extracts of the relational sources under the canonical names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, dates, rules


def swap_parties(df: DataFrame, is_entry: Column, own: str, other: str) -> DataFrame:
    """Registration, municipality and state of the two parties as entry and exit side.

    On an entry document the party itself buys; otherwise it sells.
    """
    cols = {}
    for part in ("reg", "muni", "state"):
        a, b = f"{own}_{part}", f"{other}_{part}"
        cols[f"entry_{part}"] = rules.by_direction(is_entry, a, b)
        cols[f"exit_{part}"] = rules.by_direction(is_entry, b, a)
    return df.withColumns(cols)


def invoices(
    headers: DataFrame, items: DataFrame, model: str | None, first: str, last: str,
    retained: DataFrame | None = None,
) -> DataFrame:
    """Issued, received and consumer invoices: authorised documents of a model with their items.

    Headers: id, direction (0 entry), issuer_* and recipient_* (reg, muni, state), model, result,
    emitted, total, cancel_protocol. Items: id, item_id, amounts.
    """
    h = headers.where(dates.between("emitted", first, last) & (F.col("result") == K.AUTHORISED))
    if model:
        h = h.where(F.col("model") == model)
    i = items
    if retained is not None:
        i = i.join(retained.select("item_id", "retained"), "item_id", "left")
    else:
        i = i.withColumn("retained", F.lit(None).cast("decimal(17,2)"))
    value = rules.fuel_item_value(
        "fuel_code", "gross", "discount", "waiver", "substituted_tax", "retained",
        "freight", "insurance", "other", "ipi", "import_tax",
    )
    i = i.withColumn("value_added", value)
    out = swap_parties(h.join(i, "id"), F.col("direction") == 0, "issuer", "recipient")
    return out.withColumns(
        {
            "period": dates.period("emitted"),
            "direction_code": F.when(F.col("direction") == 0, "E").otherwise("S"),
            "cancelled": F.coalesce(F.col("cancel_protocol"), F.lit(0)) != 0,
        }
    )


def latest_ledger_files(files: DataFrame, first: str, last: str, periods: tuple[int, int]) -> DataFrame:
    """Last delivery per taxpayer and period inside the delivery window.

    The latest time is a reduced side joined back: no taxpayer's files meet in one task.
    """
    seen = files.where(
        (F.col("status") == "S") & (F.col("model") == "E")
        & F.col("period").between(*periods) & dates.between("delivered", first, last)
    )
    newest = seen.groupBy("reg", "period").agg(F.max("delivered").alias("delivered"))
    return seen.join(newest, ["reg", "period", "delivered"], "left_semi")


def ledger_notes(files: DataFrame, notes: DataFrame, items: DataFrame) -> DataFrame:
    """Entry notes and items of the given ledger files, in one join rather than file by file."""
    n = notes.where(
        F.col("access_key").isNotNull() & (F.col("direction") == 0)
        & F.col("situation").isin(*K.LEDGER_SITUATIONS)
    )
    return (
        files.select("file_id", F.col("reg").alias("entry_reg"))
        .join(n, "file_id").join(items, "note_id")
        .withColumns(
            {
                "value_added": rules.ledger_item_value("gross", "discount", "ipi"),
                "period": dates.period("emitted"),
                "exit_reg": F.coalesce("party_reg", codes.registration("outside_reg"), F.lit(0)),
                "exit_state": F.coalesce("outside_state", F.lit(K.HOME_STATE)),
            }
        )
    )


TELECOM_KEYS = ["issuer_company", "day", "series", "number", "version"]
TELECOM_RECIPIENT = [
    "recipient_company", "recipient_reg", "recipient_code", "account", "recipient_name", "recipient_state",
]


def telecom(docs: DataFrame, items: DataFrame, recipients: DataFrame, first: int, last: int) -> DataFrame:
    """Telecom documents, items and recipients on their composite keys; zero bases go.

    The value is worked out and the days are chosen on both sides before the items are dealt out by the keys, so
    that the columns it comes from stay behind where they are not asked for.
    """
    inside = F.col("day").between(first, last)
    valued = items.where(inside & (F.col("base") != 0)).withColumn("value_added", rules.telecom_value("rate", "base", "exempt"))
    rest = [c for c in items.columns if c not in (*TELECOM_KEYS, *TELECOM_RECIPIENT)]
    kept = [c for c in docs.columns if c not in (*TELECOM_KEYS, *TELECOM_RECIPIENT)]
    more = [c for c in recipients.columns if c not in TELECOM_RECIPIENT]
    joined = docs.where(inside).join(valued, TELECOM_KEYS).join(recipients, TELECOM_RECIPIENT)
    return joined.withColumn("period", F.floor(F.col("day") / 100).cast("int")).select(
        *TELECOM_RECIPIENT, *TELECOM_KEYS, *kept, *rest, *more, "value_added", "period"
    )


def loose_star(facts: DataFrame, parties: DataFrame, munis: DataFrame, days: DataFrame) -> DataFrame:
    """Loose invoices from the star schema: roles by operation type, sentinels to null.

    The dimensions are joined once per role; Spark broadcasts those its size check allows.
    """
    def role(prefix: str) -> DataFrame:
        p = parties.select(
            F.col("party_id").alias(f"{prefix}_party"),
            F.when(F.col("contributor") == K.NO_CODE, F.nullif("informed_reg", F.lit(0)))
            .otherwise(F.col("known_reg")).alias(f"{prefix}_reg"),
        )
        return p

    f = facts.join(role("sender"), "sender_party", "left").join(role("receiver"), "receiver_party", "left")
    for side in ("sender", "receiver"):
        m = munis.select(F.col("muni").alias(f"{side}_muni"), F.col("state").alias(f"{side}_state"))
        f = f.join(m, f"{side}_muni", "left")
        f = f.withColumn(f"{side}_muni", codes.remap_muni(f"{side}_muni"))
    f = f.join(days, "day_id")
    is_entry = F.col("operation") == 3
    out = swap_parties(f, is_entry, "sender", "receiver")
    return out.withColumn("direction_code", F.when(is_entry, "E").otherwise("S"))


def energy(bills: DataFrame, items: DataFrame, events: DataFrame) -> DataFrame:
    """Energy bills with items, and whether a cancel event exists."""
    cancel = (
        events.where(F.col("kind").isin(*K.EVENT_CANCEL)).groupBy("access_key")
        .agg(F.max("at").alias("cancelled_at"))
    )
    return bills.join(items, "access_key", "left").join(cancel, "access_key", "left")


def tickets(docs: DataFrame, events: DataFrame) -> DataFrame:
    """Tickets with reason 10 where an event stopped them."""
    stop = events.where(F.col("kind").isin(*K.TICKET_STOP_EVENTS)).select("access_key").distinct()
    marked = docs.join(stop.withColumn("reason", F.lit(K.CANCELLED)), "access_key", "left")
    return marked.withColumn("appropriation", F.lit("S"))


def option_periods(
    simplified: DataFrame, micro: DataFrame, registrations: DataFrame, first: int, last: int
) -> DataFrame:
    """Periods of both simplified-regime registers updated in [first, last), with registration.

    Columns: start, stop, base, updated, option_no, open_type (true for open type-5 rows).
    """
    both = simplified.withColumn("register", F.lit(1)).unionByName(micro.withColumn("register", F.lit(2)))
    kept = both.where((F.col("updated") >= first) & (F.col("updated") < last))
    base = F.when(F.length(F.col("base").cast("string")) < 8, F.lpad(F.col("base").cast("string"), 8, "0"))
    kept = kept.withColumn("base", F.coalesce(base, F.col("base").cast("string")))
    return (
        kept.join(registrations.select("base", "reg"), "base", "left")
        .select(
            "base", F.coalesce("reg", F.lit(0)).alias("reg"), "register", "option_no",
            dates.date_from_number("start").alias("start"), dates.date_from_number("stop").alias("stop"),
            dates.date_from_number("updated").alias("updated"), (~F.col("open_type")).alias("valid"),
        )
    )


def registrations_of_month(docs: DataFrame, reg: str, period: int, registry: DataFrame) -> DataFrame:
    """Distinct registrations of a month (up to nine digits), and whether the registry has them."""
    r = docs.where((F.col("period") == period) & (F.col(reg) > 0) & (F.length(F.col(reg).cast("string")) <= 9))
    seen = r.select(F.col(reg).alias("reg")).distinct()
    known = registry.select("reg").distinct().withColumn("known", F.lit(True))
    return seen.join(known, "reg", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def stored_documents(
    docs: DataFrame, doc_type: int | None = None, window: tuple[str, str] | None = None,
    keys: DataFrame | None = None, on: str = "access_key",
) -> DataFrame:
    """Stored documents or items by type, window and key list."""
    out = docs
    if doc_type is not None:
        out = out.where(F.col("doc_type") == doc_type)
    if window:
        out = out.where(dates.between("emitted_at", *window))
    return out.join(keys.select(on).distinct(), on, "left_semi") if keys is not None else out
