"""Roll-ups: items to documents, events to keys, counters (DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, rules

ITEM, DOCUMENT = 1, 2


def item_rollup(items: DataFrame, key: str | list[str], value="value_added") -> DataFrame:
    """Any participating code and product, value and highest type per document."""
    keys = [key] if isinstance(key, str) else key
    return items.groupBy(*keys).agg(
        F.coalesce(F.bool_or("code_participates"), F.lit(False)).alias("code_participates"),
        F.coalesce(F.bool_or("product_participates"), F.lit(False)).alias("product_participates"),
        F.sum(rules.amount(value)).cast("decimal(17,2)").alias("value_added"),
        F.max("item_doc_type").alias("doc_type"),
    )


def participation_split(
    items: DataFrame,
    key: str | list[str],
    value: str = "value_added",
    participates: str = "code_participates",
    item_reason: str | None = None,
) -> DataFrame:
    """Value of participating and other items per document, with the highest item reason.

    Document-level rules do not vary inside a document, so they are applied to the rolled-up row
    (``settle``) and the items are reduced before any join.
    """
    keys = [key] if isinstance(key, str) else key
    part = F.coalesce(F.col(participates), F.lit(False))
    reason = F.col(item_reason) if item_reason else F.when(~part, K.OP_CODE_OUT)
    zero = F.lit(0).cast("decimal(27,2)")
    return items.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(part, F.col(value))), zero).cast("decimal(17,2)").alias("value_in"),
        F.coalesce(F.sum(F.when(~part, F.col(value))), zero).cast("decimal(17,2)").alias("value_out"),
        F.max(reason).cast("int").alias("item_reason"),
    )


def settle(
    split: DataFrame, document_reasons: list[tuple[Column, int]], document_level: bool = True
) -> DataFrame:
    """Final value and reason per document.

    Reasons are listed weakest first. One that holds moves all value to the excluded side. A zero
    sum that no document-level reason explains becomes reason 12, a non-zero sum means the
    document participates (null reason). ``document_level=False`` keeps the telecom behaviour, in
    which a cancelled document with no value left still reports reason 12.
    """
    reason, hit = F.col("item_reason"), F.lit(False)
    for cond, code in document_reasons:
        c = F.coalesce(cond, F.lit(False))
        reason, hit = F.when(c, F.lit(code)).otherwise(reason), hit | c
    moved = F.when(hit, F.lit(0).cast("decimal(17,2)")).otherwise(F.col("value_in"))
    other = F.when(hit, F.col("value_in") + F.col("value_out")).otherwise(F.col("value_out"))
    out = (
        split.withColumn("__reason", reason)
        .withColumn("__hit", hit if document_level else F.lit(False))
        .withColumn("__in", moved.cast("decimal(17,2)"))
        .withColumn("value_out", other.cast("decimal(17,2)"))
        .withColumn("value_in", F.col("__in"))
    )
    final = (
        F.when(F.col("value_in") != 0, None)
        .when(F.col("__hit"), F.col("__reason"))
        .otherwise(F.lit(K.NO_ITEM_LEFT))
    )
    return out.withColumn("reason", final.cast("int")).drop("__reason", "__hit", "__in", "item_reason")


def classified_events(events: DataFrame, key: str, kind: str, at: str) -> DataFrame:
    """access_key, at and kinds: what the code or the words of each event do to its document.

    Events without a document key go.
    """
    told = F.upper(F.col(kind).cast("string"))
    by_word = [F.when(told.contains(word), F.lit(k)) for word, k in K.EVENT_KIND_OF_WORD.items()]
    by_code = codes.lookup(codes.digits_only(told), K.EVENT_KIND_OF_CODE)
    return events.select(
        codes.blank_to_null(F.col(key).cast("string")).alias("access_key"), F.col(at).alias("at"),
        F.array_compact(F.array(by_code, *by_word)).alias("kinds"),
    ).where("access_key is not null")


def kind_flags(kinds: str = "kinds") -> dict[str, Column]:
    """One flag per kind of event."""
    return {k: F.array_contains(kinds, k) for k in K.EVENT_KINDS}


def collapse_events(events: DataFrame, key: str = "access_key") -> DataFrame:
    """One row per document of classified events: flags, last cancellation, last event."""
    flags = kind_flags()
    return events.groupBy(key).agg(
        *[F.bool_or(hit).alias(k) for k, hit in flags.items()],
        F.max(F.when(flags["cancelled"], F.col("at"))).alias("cancelled_at"), F.max("at").alias("last_event_at"),
    )


def coded_events(
    events: DataFrame, key: str, kind: str, substitute: tuple[str, ...], void: tuple[str, ...] = ()
) -> DataFrame:
    """Flags per document from event codes only (transport and energy)."""
    k = F.col(kind).cast("string")

    def any_of(codes_):
        hit = k.isin(*codes_) if codes_ else F.lit(False)
        return F.coalesce(F.bool_or(hit), F.lit(False))

    return events.groupBy(key).agg(
        any_of(K.EVENT_CANCEL).alias("cancelled"),
        any_of(substitute).alias("substituted"),
        any_of(K.EVENT_CORRECTION).alias("corrected"),
        any_of(void).alias("voided"),
    )


def first_known(sources: list[DataFrame], key: str, cols: list[str]) -> DataFrame:
    """First non-null value per key over ranked sources; equal ranks take the lesser value."""
    ranked = None
    for rank, s in enumerate(sources):
        part = s.withColumn("__rank", F.lit(rank))
        ranked = part if ranked is None else ranked.unionByName(part, allowMissingColumns=True)
    picks = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("__rank", c))).alias(c)
        for c in cols
    ]
    return ranked.groupBy(key).agg(*picks)


def sums(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    return df.groupBy(key).agg(
        *[F.sum(F.col(c).cast("decimal(17,2)")).alias(n) for c, n in cols.items()]
    )


def counters(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows in total and per true / false flag, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.count_if(F.col(f)), F.lit(0)).alias(f"{f}_yes") for f in flags],
        *[F.coalesce(F.count_if(~F.col(f)), F.lit(0)).alias(f"{f}_no") for f in flags],
    )


def approximate_documents(df: DataFrame, key: str, rsd: float = 0.02) -> DataFrame:
    return df.agg(F.approx_count_distinct(key, rsd).alias("documents"))


def count_sketches(df: DataFrame, by: list[str], key: str, precision: int = 14) -> DataFrame:
    """(by, sketch, rows): a mergeable sketch of the distinct keys of each group, of bounded size.

    The key is a whole number, a text or bytes. Stored by day and type, sketches answer for any window without
    its rows; a day loaded again replaces its own. The standard error is about 1.04 / sqrt(2^precision).
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, F.lit(precision)).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def sketched_count(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, documents, rows): estimated distinct keys of all sketches of a group, merged."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("rows").alias("rows"))
    return merged.select(*by, F.hll_sketch_estimate("sketch").alias("documents"), "rows")


def parties_seen(
    docs: DataFrame, entry: tuple[str, str, str], exit_: tuple[str, str, str], home: str = K.HOME_STATE
) -> DataFrame:
    """Distinct registrations of both sides with one municipality; columns (reg, muni, state)."""
    sides = F.array(
        *[
            F.struct(
                F.col(r).cast("bigint").alias("reg"),
                F.coalesce(F.col(s), F.lit(home)).alias("state"),
                F.col(m).alias("muni"),
            )
            for r, m, s in (entry, exit_)
        ]
    )
    return (
        docs.select(F.inline(sides))
        .where(F.col("reg").isNotNull() & (F.col("reg") != 0))
        .groupBy("reg", "state")
        .agg(F.min("muni").alias("muni"))
    )


def positive_totals(docs: DataFrame, keys: list[str], value: str, annulled: str) -> DataFrame:
    """Totals of documents without an annulment key, positive ones only."""
    total = F.sum(F.col(value)).alias(value)
    return docs.where(F.col(annulled).isNull()).groupBy(*keys).agg(total).where(F.col(value) > 0)


def declarations(
    df: DataFrame, first: int, last: int, id_: str = "id", activity: str = "activity",
    period: str = "period", amount: str = "amount", other: list[str] | None = None,
) -> DataFrame:
    """Totals of the latest batch per declaration, and the share of them that counts.

    Keeps rows of the highest sequence per batch key. The maximum is a reduced side joined back,
    so no batch is gathered in one task.
    """
    d = df.where(F.col(period).between(first, last)).withColumn("__id", codes.declaration_id(id_))
    d = d.select("*", "__id.batch_key", "__id.sequence", F.col("__id.id").alias("declaration"))
    newest = d.groupBy("batch_key").agg(F.max("sequence").alias("sequence"))
    keys = ["declaration", period, *(other or [])]
    kept = d.join(newest, ["batch_key", "sequence"], "left_semi")
    value = F.coalesce(codes.number(amount, 17, 2), F.lit(0).cast("decimal(17,2)"))
    total = kept.where(F.col(activity).isin(*K.DECLARATION_ACTIVITIES)).groupBy(*keys).agg(
        F.sum(value).cast("decimal(19,2)").alias("total")
    )
    share = (F.col("total") * F.lit(K.DECLARATION_SHARE).cast("decimal(3,2)")).cast("decimal(21,4)")
    return total.withColumn("counted", share)
