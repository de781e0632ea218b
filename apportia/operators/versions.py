"""Differences between two versions of a table, and validity merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia.operators import spans
from apportia.operators.history import one_second
from apportia.operators.joins import FOREVER, tick
from apportia.operators.spans import Measure


def new_rows(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    return incoming.join(stored.select(*keys), keys, "left_anti")


def gone_rows(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    return stored.join(incoming.select(*keys), keys, "left_anti")


def changed_rows(
    stored: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str]
) -> DataFrame:
    """Incoming rows whose key is stored with other values; null equals null."""
    old = stored.select(*keys, *[F.col(a).alias(f"__old_{a}") for a in attrs])
    differs = reduce(
        lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(f"__old_{a}")) for a in attrs]
    )
    return incoming.join(old, keys).where(differs).select(*incoming.columns)


def difference(
    stored: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str]
) -> DataFrame:
    """Three-way difference in one full outer join: action is added, removed or changed."""
    here = F.lit(True)
    s = stored.select(*keys, *[F.col(a).alias(f"__old_{a}") for a in attrs], here.alias("__stored"))
    i = incoming.select(*keys, *attrs, here.alias("__incoming"))
    differs = reduce(
        lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(f"__old_{a}")) for a in attrs]
    )
    action = (
        F.when(F.col("__stored").isNull(), "added")
        .when(F.col("__incoming").isNull(), "removed")
        .when(differs, "changed")
    )
    value = lambda a: F.when(F.col("__incoming").isNull(), F.col(f"__old_{a}")).otherwise(F.col(a))
    return (
        s.join(i, keys, "full_outer")
        .select(*keys, *[value(a).alias(a) for a in attrs], action.alias("action"))
        .where(F.col("action").isNotNull())
    )


def apply_difference(stored: DataFrame, diff: DataFrame, keys: list[str]) -> DataFrame:
    """Stored table after a difference: removed rows go, added and changed rows are taken."""
    kept = stored.join(diff.select(*keys), keys, "left_anti")
    taken = diff.where(F.col("action") != "removed").select(*stored.columns)
    return kept.unionByName(taken)


def merge_validity(
    stored: DataFrame, incoming: DataFrame, key: str, kind: str
) -> tuple[DataFrame, DataFrame]:
    """(changes, rejected rows) of an incoming membership list; columns (key, start, stop, kind).

    The latest stored period of each key decides. A stored open period is closed a second before the new start, a new period is inserted, an
    unchanged start does nothing. An incoming start before the stored start, or before a stored
    end, is rejected.
    """
    latest = spans.best_row(stored, [key], ["start", kind])
    s = latest.select(
        F.col(key).alias("__key"), F.col("start").alias("__start"), F.col("stop").alias("__stop"),
        F.col(kind).alias("__kind"),
    )
    m = incoming.join(s, F.col(key) == F.col("__key"), "left")
    backdated = F.coalesce(F.col("__start") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("__stop") > F.col("start"), F.lit(False)
    )
    rejected = m.where(backdated).select(*incoming.columns).distinct()
    good = m.where(~backdated & ~F.col("__start").eqNullSafe(F.col("start")))
    closing = F.col("__start").isNotNull() & F.col("__stop").isNull()
    rows = F.array_compact(
        F.array(
            F.when(
                closing,
                F.struct(
                    F.col("__start").alias("start"), (F.col("start") - one_second()).alias("stop"),
                    F.col("__kind").alias(kind), F.lit("close").alias("action"),
                ),
            ),
            F.struct("start", "stop", F.col(kind), F.lit("insert").alias("action")),
        )
    )
    return good.select(key, F.inline(rows)).distinct(), rejected


def changed_spans(
    old: DataFrame, new: DataFrame, keys: list[str], start: str, stop: str, attrs: list[str]
) -> DataFrame:
    """(keys, start, stop) of the spans in which the version in force differs in ``attrs``; null equals null.

    Both registries are without overlaps, so each is a row of values along time. Their bounds are put in one
    line per key, each side's value is carried along it, and where the two differ there is a span.
    """
    t = old.schema[start].dataType.simpleString()

    def bounds(versions: DataFrame, side: str) -> DataFrame:
        end = F.coalesce(F.col(stop), F.lit(FOREVER).cast(t)) + tick()
        row = F.struct(*attrs)
        point = lambda at, first, held: F.struct(at.alias("at"), F.lit(first).alias("first"), held.alias("held"))
        both = F.array(point(F.col(start), True, row), point(end, False, F.when(F.lit(False), row)))
        return versions.select(*keys, F.lit(side).alias("__side"), F.explode(both).alias("__b")).select(
            *keys, "__side", F.col("__b.at").alias("__at"), F.col("__b.first").alias("__first"), F.struct("__b.held").alias("__held")
        )

    line = spans.running(
        bounds(old, "old").unionByName(bounds(new, "new")), keys, ["__at", "__first", "__side"], spans.month_span("__at"),
        {
            "__old": Measure(F.when(F.col("__side") == "old", F.col("__held")), "last"),
            "__new": Measure(F.when(F.col("__side") == "new", F.col("__held")), "last"),
            "__after": spans.following(["__at"]),
        },
    )
    # The last of bounds at one time has seen all of them; beyond the last time nothing is in force.
    differs = ~F.col("__old.held").eqNullSafe(F.col("__new.held"))
    end = F.col("__after.__at") - tick()
    return line.where((F.col("__after.__at") > F.col("__at")) & differs).select(
        *keys, F.col("__at").alias(start), F.when(end < F.lit(FOREVER).cast(t), end).alias(stop)
    )
