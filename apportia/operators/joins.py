"""Reference, registry and period joins (DataFrame -> DataFrame)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions.codes import col
from apportia.operators import spans
from apportia.operators.spans import Measure
from apportia.session import cut_lineage


def fan_in(base: DataFrame, parts: list[DataFrame], on: list[str]) -> DataFrame:
    """Left joins of document or item sections on the same key: one shuffle of the base.

    Sections have a row per document or item, whatever their size on disk, so none is gathered by the driver.
    """
    return reduce(lambda left, right: left.join(right.hint("merge"), on, "left"), parts, base)


def keep_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is listed; replaces batched key lists."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def participation_flag(
    df: DataFrame, codes: DataFrame, on: str, code: str, flag: str
) -> DataFrame:
    """True where the code is in the reference, false otherwise.

    The list of codes is sent to all tasks: few codes hold most rows, so the rows are not dealt by code.
    """
    ref = codes.select(F.col(code).alias("__code")).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(F.broadcast(ref), F.col(on) == F.col("__code"), "left")
    return joined.withColumn(flag, F.coalesce("__hit", F.lit(False))).drop("__code", "__hit")


def attach(
    df: DataFrame, ref: DataFrame, on: str, key: str, cols: dict[str, str]
) -> DataFrame:
    """Left lookup; ``cols`` maps reference column to new name. The reference key is unique."""
    right = ref.select(F.col(key).alias("__key"), *[F.col(c).alias(n) for c, n in cols.items()])
    return df.join(right, F.col(on) == F.col("__key"), "left").drop("__key")


def product_id(items: DataFrame, products: DataFrame, code: str, first, last) -> DataFrame:
    """Id of the product code among the references valid over a whole window."""
    from apportia.functions.codes import product_code
    from apportia.functions.dates import covers

    live = products.where(covers("start", "stop", first, last)).groupBy("code").agg(F.max("id").alias("id"))
    coded = items.withColumn("__product", product_code(code))
    return attach(coded, live, "__product", "code", {"id": "product_id"}).drop("__product")


def latest_reference(ref: DataFrame, code: str, start: str, tie: list[str]) -> DataFrame:
    """Row with the latest start per code, null starts last."""
    return spans.best_row(ref, [code], [F.col(start).isNotNull(), start, *tie])


def prefer_known(ref: DataFrame, code: str, value: str) -> DataFrame:
    """One row per code; a known flag beats a null one and yes beats no."""
    return ref.groupBy(code).agg(F.max(value).alias(value))


def municipality(
    df: DataFrame, munis: DataFrame, code: str, state: str, name: str | None = None,
    document_state: str | None = None,
) -> DataFrame:
    """State (and name) of a municipality; the document's own state fills gaps."""
    right = munis.select(
        F.col("muni").alias("__muni"), F.col("state").alias("__state"), F.col("name").alias("__name")
    )
    out = df.join(right, F.col(code) == F.col("__muni"), "left")
    found = F.col("__state")
    out = out.withColumn(
        state, F.coalesce(found, F.col(document_state)) if document_state else found
    )
    if name:
        out = out.withColumn(name, F.col("__name"))
    return out.drop("__muni", "__state", "__name")


# --- as-of registry -------------------------------------------------------------------------

FOREVER = "9999-12-31 00:00:00"


def tick() -> Column:
    return F.expr("INTERVAL 0.000001 SECOND")


def without_overlaps(
    registry: DataFrame, keys: list[str], start: str, stop: str, tie: list[str], store=cut_lineage
) -> DataFrame:
    """Cut validity so that at any time at most one version of a key is in force: the one with
    the latest start, then open or latest end, then the highest ``tie``.

    Versions that touch no other pass through; only the rest are split at each other's bounds, see
    ``in_force``. ``store`` materialises what both parts read.
    """
    t = registry.schema[start].dataType.simpleString()
    cols = registry.columns
    open_end = F.coalesce(F.col(stop), F.lit(FOREVER).cast(t))
    base = registry.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    base = base.where(F.col(start).isNotNull()).withColumn("__stop", open_end)
    order = [start, "__stop", *tie]
    span = spans.month_span(start)
    seen = spans.running(
        base, keys, order, span,
        {
            "__before": Measure(F.col("__stop"), "max", inclusive=False),
            "__after": spans.following([start]),
        },
    )
    after = F.col(f"__after.{start}")
    alone = (F.col("__before").isNull() | (F.col("__before") < F.col(start))) & (
        after.isNull() | (F.col("__stop") < after)
    )
    marked = store(seen.withColumn("__alone", alone))
    clean = marked.where("__alone").select(*cols)
    mixed = marked.where(~F.col("__alone")).select(*cols, "__stop")
    pieces = in_force(mixed, keys, start, "__stop", tie, store)
    end = F.least(F.col("__row.__stop"), F.col("__next") - tick())
    rest = [c for c in cols if c not in (*keys, start, stop)]
    split = pieces.select(
        *keys,
        F.col("__at").alias(start),
        F.when(end < F.lit(FOREVER).cast(t), end).alias(stop),
        *[F.col(f"__row.{c}").alias(c) for c in rest],
    ).select(*cols)
    return clean.unionByName(split)


def in_force(
    versions: DataFrame, keys: list[str], start: str, stop: str, tie: list[str], store=cut_lineage
) -> DataFrame:
    """(keys, __at, __next, __row): from each bound of a key to its next one, the version in force.

    Starts and ends of a key's versions are numbered along time, so a version is a range of numbers. The range
    is written as blocks whose sizes are powers of two, of which the best version is kept; a bound looks at
    the blocks that hold its number, one of each size. With n versions of a key that is n log n rows meeting
    on equality, however many are open at once, and no key is gathered anywhere.
    """
    row = F.struct(*[F.col(c) for c in versions.columns])
    bound = lambda at, first: F.struct(at.alias("at"), F.lit(first).alias("first"))
    events = versions.select(
        *keys, row.alias("__row"),
        F.explode(F.array(bound(F.col(start), True), bound(F.col(stop) + tick(), False))).alias("__bound"),
    ).select(*keys, "__row", F.col("__bound.at").alias("__at"), F.col("__bound.first").alias("__first"))
    one = F.lit(1).cast("bigint")
    numbered = store(
        spans.running(
            events, keys, ["__at", "__first", "__row"], spans.month_span("__at"),
            {
                "__number": Measure(one, "sum", inclusive=False), "__left": Measure(one, "sum", reverse=True),
                "__after": spans.following(["__at"]),
            },
        ).withColumn("__number", F.coalesce("__number", F.lit(0)))
    )
    when = lambda first: F.max(F.when(F.col("__first") == first, F.col("__number")))
    ranges = numbered.groupBy(*keys, "__row").agg(when(True).alias("__low"), when(False).alias("__high"))

    def blocks(level: Column) -> Column:
        size = F.call_function("shiftleft", one, level)
        low = F.ceil(F.col("__low") / size)
        high = F.floor(F.col("__high") / size)
        block = lambda number, odd: F.when(
            (low < high) & (odd % 2 == 1), F.struct(level.alias("level"), number.alias("block"))
        )
        return F.array(block(low, low), block(high - 1, high))

    levels = lambda number: F.sequence(F.lit(0), F.floor(F.log2(F.greatest(number, F.lit(1)))).cast("int"))
    place = F.struct(F.col(f"__row.{start}"), F.col(f"__row.{stop}"), *[F.col(f"__row.{c}") for c in tie])
    best = ranges.select(
        *keys, "__row", F.explode(F.array_compact(F.flatten(F.transform(levels(F.col("__high")), blocks)))).alias("__block")
    ).groupBy(*keys, "__block").agg(F.max_by("__row", place).alias("__row"))
    # Of bounds at the same time the last one counts: all that start or end then have done so.
    last = numbered.where(F.col("__after").isNull() | (F.col("__after.__at") != F.col("__at")))
    holding = lambda level: F.struct(
        level.alias("level"), F.call_function("shiftright", F.col("__number"), level).alias("block")
    )
    asked = last.select(
        *keys, "__at", F.col("__after.__at").alias("__next"),
        F.explode(F.transform(levels(F.col("__number") + F.col("__left")), holding)).alias("__block"),
    )
    return asked.join(best, [*keys, "__block"]).groupBy(*keys, "__at", "__next").agg(F.max_by("__row", place).alias("__row"))


def as_of(
    docs: DataFrame,
    registry: DataFrame,
    on: dict[str, str],
    at: str,
    start: str,
    stop: str,
    take: dict[str, str],
    tie: list[str],
    window: tuple[str, str] | None = None,
    disjoint: bool = False,
) -> DataFrame:
    """Registry row in force at each document's time, latest start first; unmatched rows stay.

    ``on`` maps document column to registry column, ``take`` registry column to new name.
    Overlaps are resolved on the registry, so a document meets at most one version and is never
    regrouped: it is shuffled once, or not at all when the registry is small enough to broadcast.
    ``disjoint`` says the registry has no overlaps already.

    ``window`` gives the dates most documents fall in. Versions are then listed by year and the
    year joins the key, which spreads a party holding many documents over the years. Years
    outside the window are read as its first or last one, so any window gives the same rows. The
    list is longer than its size on disk tells, so it is shuffled, never gathered by the driver.
    """
    reg_keys = list(on.values())
    versions = registry.select(*dict.fromkeys([*reg_keys, start, stop, *take, *tie]))
    if not disjoint:
        versions = without_overlaps(versions, reg_keys, start, stop, tie)
    right = versions.select(
        *[F.col(r).alias(f"__r{i}") for i, r in enumerate(reg_keys)],
        F.col(start).alias("__from"), F.col(stop).alias("__to"),
        *[F.col(c).alias(f"__take_{n}") for c, n in take.items()],
    )
    cond = [F.col(d) == F.col(f"__r{i}") for i, d in enumerate(on)]
    left = docs
    if window:
        low, high = (int(w[:4]) for w in window)
        year = lambda c: F.greatest(F.least(F.year(c), F.lit(high)), F.lit(low))
        last = F.coalesce(year(F.col("__to")), F.lit(high))
        years = F.sequence(year(F.col("__from")), F.greatest(last, year(F.col("__from"))))
        right = right.withColumn("__year", F.explode(years)).hint("merge")
        left = docs.withColumn("__doc_year", year(F.col(at)))
        cond.append(F.col("__doc_year") == F.col("__year"))
    cond.append(F.col("__from") <= F.col(at))
    cond.append(F.col("__to").isNull() | (F.col(at) <= F.col("__to")))
    return left.join(right, cond, "left").select(
        *docs.columns, *[F.col(f"__take_{n}").alias(n) for n in take.values()]
    )


def window_registry(
    docs: DataFrame, registry: DataFrame, on: dict[str, str], first, last,
    start: str, stop: str, take: dict[str, str], default_state: tuple[str, str] | None = None,
) -> DataFrame:
    """Registry row covering a whole load window; a missing state is read as the home state."""
    from apportia.functions.dates import covers

    rows = registry.where(covers(start, stop, first, last))
    right = rows.select(
        *[F.col(r).alias(f"__r{i}") for i, r in enumerate(on.values())],
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    cond = []
    for i, d in enumerate(on):
        left = F.col(d)
        if default_state and default_state[0] == d:
            left = F.coalesce(left, F.lit(default_state[1]))
        cond.append(left == F.col(f"__r{i}"))
    return docs.join(right, cond, "left").drop(*[f"__r{i}" for i in range(len(on))])


def registry_or_default(
    parties: DataFrame, registry: DataFrame, key: str, defaults: dict[str, object]
) -> DataFrame:
    """Registry attributes, the registry's municipality first; unknown parties get defaults."""
    right = registry.select(
        F.col("reg").alias("__reg"), F.col("muni").alias("__muni"), *defaults
    )
    joined = parties.join(right, F.col(key) == F.col("__reg"), "left")
    known = F.col("__reg").isNotNull()
    return joined.select(
        *[F.coalesce("__muni", "muni").alias("muni") if c == "muni" else F.col(c) for c in parties.columns],
        *[F.when(known, F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in defaults.items()],
        F.when(known, "known").otherwise("added").alias("origin"),
    )


# --- periods --------------------------------------------------------------------------------


def in_period(
    docs: DataFrame, periods: DataFrame, day: Column | str, start: str, stop: str,
    keys: list[str] | None = None,
) -> DataFrame:
    """Periods that contain the document's day, as a left join.

    Each period is listed by day, so the join is an equality on the day (and ``keys``) instead of
    comparing every document with every period.
    """
    keys = keys or []
    days = F.explode(F.sequence(F.col(start), F.col(stop), F.expr("INTERVAL 1 DAY")))
    listed = (
        periods.select(*keys, start, stop).distinct().where(F.col(start) <= F.col(stop))
        .withColumn("__day", days)
        .select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__day", start, stop)
    )
    cond = [F.to_date(col(day)) == F.col("__day")] + [F.col(k) == F.col(f"__k_{k}") for k in keys]
    out = docs.join(listed, cond, "left").drop("__day", *[f"__k_{k}" for k in keys])
    return out.withColumn("in_period", F.col(start).isNotNull())


def in_option_period(
    docs: DataFrame, options: DataFrame, base: str, at: str, take: dict[str, str]
) -> DataFrame:
    """Every valid option period of the document's tax base that contains its time, left join."""
    right = options.where(F.col("valid")).select(
        F.col("base").alias("__base"), F.col("start").alias("__start"), F.col("stop").alias("__stop"),
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    cond = (
        (F.col(base) == F.col("__base"))
        & (F.col(at) >= F.col("__start"))
        & (F.col("__stop").isNull() | (F.col(at) <= F.col("__stop")))
    )
    return docs.join(right, cond, "left").drop("__base", "__start", "__stop")


# --- events ---------------------------------------------------------------------------------


def mark_events(docs: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Collapsed event flags onto documents, false where there was no event; shuffled, as they grow with the documents."""
    flags = ["cancelled", "substituted", "corrected", "voided"]
    have = [f for f in flags if f in events.columns]
    times = [c for c in ("cancelled_at", "last_event_at") if c in events.columns]
    out = docs.join(events.select(key, *have, *times).hint("merge"), key, "left")
    out = out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in have})
    return out


def event_reason(docs: DataFrame) -> Column:
    return (
        F.when(F.col("cancelled"), K.REASON_TEXT[K.CANCELLED])
        .when(F.col("substituted"), K.REASON_TEXT[K.SUBSTITUTED])
        .when(F.col("voided"), "document voided")
    )
