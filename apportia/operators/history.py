"""Registry history: changes, validity, regimes, activities, replay of a change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.functions import dates
from apportia.operators import spans
from apportia.operators.spans import Measure
from apportia.session import cut_lineage

def one_second() -> Column:
    return F.expr("INTERVAL 1 SECOND")


def changed_rows(
    df: DataFrame, keys: list[str], order: list[str], attrs: list[str], span: Column
) -> DataFrame:
    """Rows that differ from the one before in any attribute, and each group's first row.

    Null equals null, so a null that stays null is no change.
    """
    seen = spans.previous_row(df, keys, order, span, attrs, "__previous")
    now = F.struct(*[F.col(a) for a in attrs])
    return seen.where(
        F.col("__previous").isNull() | ~F.col("__previous").eqNullSafe(now)
    ).select(*df.columns)


def close_validity(
    df: DataFrame, keys: list[str], start: str, stop: str, span: Column | None = None
) -> DataFrame:
    """Validity ends one second before the next start; the last row stays open."""
    span = spans.month_span(start) if span is None else span
    nxt = spans.next_row(df, keys, [start], span, [start], "__next")
    return nxt.withColumn(stop, F.col(f"__next.{start}") - one_second()).drop("__next")


def daily_versions(
    df: DataFrame, keys: list[str], at: str, attrs: list[str], start: str, stop: str
) -> DataFrame:
    """Versions from timestamped rows: changes only, whole days, one version per day.

    Rows are compared in time order, then cut to the day; of several changes on one day the last
    counts, and each version ends a second before the next one starts.
    """
    base = df.select(*keys, at, *attrs).where(F.col(at).isNotNull())
    # Rows of one instant are one version.
    one = base.groupBy(*keys, at).agg(F.max(F.struct(*attrs)).alias("__v"))
    flat = one.select(*keys, at, "__v.*")
    kept = changed_rows(flat, keys, [at], attrs, spans.month_span(at))
    by_day = kept.groupBy(*keys, F.to_date(at).cast("timestamp").alias(start)).agg(
        F.max_by(F.struct(*attrs), F.col(at)).alias("__v")
    )
    closed = close_validity(by_day.select(*keys, start, "__v.*"), keys, start, stop)
    return closed.select(*keys, start, stop, *attrs)


def drop_contained(
    df: DataFrame, key: str, start: str, stop: str, number: str
) -> DataFrame:
    """Drop periods inside an earlier period of the same key; an open end is endless.

    Ordered by start, then number descending. A dropped period never reaches further than the one
    that contains it, so the running maximum of all earlier ends equals that of the kept ones.
    """
    t = df.schema[stop].dataType.simpleString()
    end = F.coalesce(F.col(stop), F.lit("9999-12-31").cast(t))
    base = df.where(F.col(key).isNotNull()).withColumns({
        "__end": end,
        "__start": F.coalesce(F.col(start), F.lit("1900-01-01").cast(df.schema[start].dataType)),
        "__rank": -F.col(number),
    })
    seen = spans.running(
        base, [key], ["__start", "__rank", "__end"], spans.month_span("__start"),
        {"__before": Measure(F.col("__end"), "max", inclusive=False)},
    )
    return seen.where(
        F.col("__before").isNull() | (F.col("__before") < F.col("__end"))
    ).select(*df.columns)


def regime_changes(
    periods: DataFrame, key: str, start: str, stop: str, number: str,
    inside: str = "3", outside: str = "2", drop_all: bool = False,
) -> DataFrame:
    """Option periods as change events: ``inside`` at the start, ``outside`` the day after the end.

    An end that meets another event of the same day goes, starts stay, and only real changes are
    kept. ``drop_all`` removes every event of a shared day instead and keeps the rest as they are,
    which is the form the replay of a change log takes.
    """
    kept = drop_contained(periods, key, start, stop, number)
    first = F.coalesce(F.to_date(start), F.lit("1900-01-01").cast("date"))
    both = F.array(
        F.struct(first.alias("at"), F.lit(inside).alias("regime"), F.lit(False).alias("is_end")),
        F.struct(
            F.date_add(F.to_date(stop), 1).alias("at"), F.lit(outside).alias("regime"),
            F.lit(True).alias("is_end"),
        ),
    )
    events = kept.select(key, F.inline(both)).where(F.col("at").isNotNull())
    per_day = events.groupBy(key, "at").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(~F.col("is_end")).alias("starts"),
        F.max("regime").alias("regime"),
    )
    # Regime of a start wins a shared day; ends alone on a shared day (two of them) go.
    keep = F.col("n") == 1
    if not drop_all:
        keep = keep | F.col("starts")
    day = per_day.where(keep).select(
        key, "at", F.when(F.col("starts"), F.lit(inside)).otherwise(F.lit(outside)).alias("regime")
    )
    if drop_all:
        return day
    return changed_rows(day, [key], ["at"], ["regime"], spans.month_span("at"))


def unique_days(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key goes."""
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").select(*keys)
    return df.join(once, keys, "left_semi")


def merge_timelines(
    sources: list[DataFrame], key: str, at: str, fill: dict[str, object], store=cut_lineage
) -> DataFrame:
    """Changes of several registers on one timeline, each attribute carried forward.

    Stacking and grouping by (key, time) gives what a chain of full outer joins would, with one
    shuffle. ``fill`` maps attribute to the value used before its first change. The line is stored, since
    carrying reads it twice, so each source is read once.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    one = store(stacked.groupBy(key, at).agg(*[F.max(c).alias(c) for c in fill]))
    line = spans.forward_fill(one, [key], [at], spans.month_span(at), list(fill))
    given = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items() if v is not None}
    return line.withColumns(given)


def changes_for_window(df: DataFrame, key: str, at: str, first, last) -> DataFrame:
    """Changes up to the window's end, back to the last one before its start.

    A key without a change before the start keeps all of them, and always its oldest row.
    """
    bounds = df.groupBy(F.col(key).alias("__key")).agg(
        F.max(F.when(F.col(at) < F.lit(first), F.col(at))).alias("__floor"),
        F.min(at).alias("__oldest"),
    )
    inside = (F.col(at) <= F.lit(last)) & (
        F.col("__floor").isNull() | (F.col(at) >= F.col("__floor"))
    )
    only = F.col("__floor").isNull() & (F.col(at) == F.col("__oldest"))
    return (
        df.join(bounds, F.col(key) == F.col("__key"))
        .where(inside | only)
        .drop("__key", "__floor", "__oldest")
    )


# --- activities -----------------------------------------------------------------------------


def activity_ledger(
    history: DataFrame, key: str, code: str, percent: str, start_period: str, end_period: str
) -> DataFrame:
    """Activity spells as signed rows: +percent at the start month, -percent the month after the end.

    Start 0 or null means 1900-01.
    """
    start = F.coalesce(
        dates.period_start(F.nullif(F.col(start_period), F.lit(0))), F.lit("1900-01-01").cast("date")
    )
    stop = F.add_months(dates.period_start(F.nullif(F.col(end_period), F.lit(0))), 1)
    rows = F.array(
        F.struct(start.alias("at"), F.col(percent).alias("percent")),
        F.struct(stop.alias("at"), (-F.col(percent)).alias("percent")),
    )
    return history.select(key, code, F.inline(rows)).where(F.col("at").isNotNull())


def rural_by_month(
    ledger: DataFrame, rural: DataFrame, key: str, code: str, months: list[str]
) -> DataFrame:
    """Rural flags before each listed day: any and all of the activities with a positive balance.

    ``ledger`` rows are listed only for the months they precede, summed per activity first.
    """
    marks = F.array(*[F.lit(m).cast("date") for m in months])
    late = F.filter(marks, lambda m: m > F.col("at"))
    balance = (
        ledger.select(key, code, "percent", "at", F.explode(late).alias("month"))
        .groupBy(key, code, "month")
        .agg(F.sum("percent").alias("percent"), F.max("at").alias("at"))
        .where(F.col("percent") > 0)
    )
    ref = rural.select(F.col("code").alias("__code")).distinct().withColumn("__rural", F.lit(True))
    flagged = balance.join(ref, F.col(code) == F.col("__code"), "left").withColumn(
        "__rural", F.coalesce("__rural", F.lit(False))
    )
    return (
        flagged.groupBy(key, "month")
        .agg(
            F.max("at").alias("changed_at"),
            F.bool_or("__rural").alias("rural"),
            F.bool_and("__rural").alias("rural_only"),
        )
        .where("rural")
    )


def rural_flags(activities: DataFrame, rural: DataFrame, key: str, code: str) -> DataFrame:
    """Any and all current activities rural, per registration."""
    ref = rural.select(F.col("code").alias("__code")).distinct().withColumn("__hit", F.lit(1))
    return (
        activities.join(ref, F.col(code) == F.col("__code"), "left")
        .groupBy(key)
        .agg(
            F.bool_or(F.col("__hit").isNotNull()).alias("rural"),
            F.bool_and(F.col("__hit").isNotNull()).alias("rural_only"),
        )
    )


# --- replay of a change log -----------------------------------------------------------------


def replay(
    current: DataFrame,
    log: DataFrame,
    key: str,
    at: str,
    attrs: list[str],
    now: str,
    counts: list[str] | None = None,
    span=spans.day_span,
) -> DataFrame:
    """Every historical version, rebuilt from today's values and a log of old values.

    The value in force from a change time is the old value of the next later change of that
    attribute, or today's value when none follows. ``log`` has (key, at, attr, old) rows; an
    attribute that was changed at an instant carries its old value as text. ``counts`` names
    running tallies (activities held): the log carries signed amounts in the same-named columns
    that undo a change, and the version's tally is today's plus those of all later changes.
    A registration without log gets one version starting ``now``.
    """
    counts = counts or []
    # Undoing goes from newest to oldest, so the oldest of several changes at one instant wins;
    # the log's sequence decides among them.
    wide = log.groupBy(key, at).agg(
        *[
            F.min_by(
                F.struct(F.col("old").alias("v")),
                F.when(F.col("attr") == a, F.struct("seq", "old")),
            ).alias(f"__old_{a}")
            for a in attrs
        ],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"__undo_{c}") for c in counts],
    )
    measures = {
        f"__next_{a}": Measure(F.col(f"__old_{a}"), "last", inclusive=False, reverse=True) for a in attrs
    }
    measures |= {
        f"__later_{c}": Measure(F.col(f"__undo_{c}"), "sum", inclusive=False, reverse=True) for c in counts
    }
    seen = spans.running(wide, [key], [at], span(at), measures)
    today = current.select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__now_{c}") for c in (*attrs, *counts)]
    )
    joined = today.join(seen, F.col("__key") == F.col(key), "left")
    values = [
        F.when(F.col(f"__next_{a}").isNotNull(), F.col(f"__next_{a}.v"))
        .otherwise(F.col(f"__now_{a}"))
        .alias(a)
        for a in attrs
    ]
    values += [
        (F.col(f"__now_{c}") + F.coalesce(F.col(f"__later_{c}"), F.lit(0))).alias(c) for c in counts
    ]
    t = log.schema[at].dataType.simpleString()
    return joined.select(
        F.col("__key").alias(key), F.coalesce(F.col(at), F.lit(now).cast(t)).alias(at), *values
    )


def municipality_undo(log: DataFrame, streets: DataFrame, key: str, at: str) -> DataFrame:
    """Municipality changes of the log as (key, at, attr, old, seq) rows.

    Two columns of the log move a taxpayer: the municipality itself and the street. The last
    known old value of each is carried over the later undone changes; the municipality in force
    is the old municipality, else the old street's, else 0.
    """
    moves = log.where(F.col("attr").isin("muni", "street"))
    ref = streets.select(F.col("street").alias("__street"), F.col("muni").cast("string").alias("__muni"))
    placed = moves.join(
        ref, (F.col("attr") == "street") & (F.col("old") == F.col("__street")), "left"
    )
    wide = placed.groupBy(key, at).agg(
        F.max(F.when(F.col("attr") == "muni", F.coalesce("old", F.lit("0")))).alias("own"),
        F.max(F.when(F.col("attr") == "street", F.coalesce("__muni", F.lit("0")))).alias("by_street"),
    )
    line = spans.running(
        wide, [key], [at], spans.day_span(at),
        {
            "__own": Measure(F.col("own"), "last", reverse=True),
            "__street": Measure(F.col("by_street"), "last", reverse=True),
        },
    )
    known = F.coalesce(
        F.nullif(F.col("__own"), F.lit("0")), F.nullif(F.col("__street"), F.lit("0")), F.lit("0")
    )
    return line.select(key, at, F.lit("muni").alias("attr"), known.alias("old"), F.lit(0).alias("seq"))


def log_rows(
    raw: DataFrame, held: DataFrame, rural: DataFrame, streets: DataFrame, regimes: DataFrame
) -> DataFrame:
    """Change log in the form ``replay`` takes, from the registry's own log and the regime events.

    ``raw`` has (reg, at, seq, table, column, kind, new, old), ``held`` the activity rows
    (activity_id, subclass), ``rural`` the rural subclasses, ``regimes`` the result of
    ``regime_changes`` with ``drop_all``. Undoing an insert takes an activity away, undoing a
    delete gives it back; the two municipality columns become one attribute.
    """
    from apportia import constants as K

    def is_(pair: tuple[str, str]) -> Column:
        return (F.col("table") == pair[0]) & (F.col("column") == pair[1])

    attr = (
        F.when(is_(K.LOG_STATUS), "status").when(is_(K.LOG_MUNICIPALITY), "muni").when(is_(K.LOG_STREET), "street")
    )
    plain = raw.withColumn("attr", attr)
    moves = municipality_undo(
        plain.where(F.col("attr").isin("muni", "street")).select("reg", "at", "attr", "old"), streets, "reg", "at"
    )
    status = plain.where(F.col("attr") == "status").select("reg", "at", "attr", "old", "seq")
    regime = regimes.select(
        "reg", F.col("at").cast(raw.schema["at"].dataType), F.lit("regime").alias("attr"),
        F.when(F.col("regime") == "2", "3").otherwise("2").alias("old"), F.lit(0).alias("seq"),
    )
    added = raw.where(is_(K.LOG_ACTIVITY_ADDED) & (F.col("kind") == "I"))
    removed = raw.where(is_(K.LOG_ACTIVITY_REMOVED) & (F.col("kind") == "D"))
    added = added.join(
        held.select(F.col("activity_id").cast("string").alias("new"), F.col("subclass").cast("string").alias("__subclass")),
        "new", "left",
    ).withColumn("activities", F.lit(-1).cast("bigint"))
    removed = removed.withColumns({"__subclass": F.col("old"), "activities": F.lit(1).cast("bigint")})
    cols = ["reg", "at", "seq", "__subclass", "activities"]
    ref = rural.select(F.col("code").cast("string").alias("__code")).distinct()
    moved = (
        added.select(*cols).unionByName(removed.select(*cols))
        .join(ref, F.col("__subclass") == F.col("__code"), "left")
        .select(
            "reg", "at", F.lit("activity").alias("attr"), F.lit(None).cast("string").alias("old"), "seq", "activities",
            F.when(F.col("__code").isNotNull(), F.col("activities")).alias("rural_activities"),
        )
    )
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [moved, status, moves, regime]
    )
