"""Value added and the municipal participation index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apportia import constants as K


VALUE_KEY = ["doc_type", "period", "direction", "reg", "muni"]


def value_added(
    docs: DataFrame, registry: DataFrame, munis: DataFrame, home: str = K.HOME_STATE
) -> DataFrame:
    """Value by registration, municipality, period, document type and direction."""
    return value_counted(docs.withColumn("__sign", F.lit(1)), registry, munis, home).drop("documents")


def value_change(
    gone: DataFrame, come: DataFrame, registry: DataFrame, munis: DataFrame, home: str = K.HOME_STATE
) -> DataFrame:
    """What the totals change by when documents go and others come: the former count negative, the latter positive."""
    rows = gone.withColumn("__sign", F.lit(-1)).unionByName(come.withColumn("__sign", F.lit(1)))
    return value_counted(rows, registry, munis, home).where("documents <> 0 OR value_added <> 0")


def merge_totals(totals: DataFrame, change: DataFrame) -> DataFrame:
    """Totals (with their number of documents) after a change; one that no document is left in goes."""
    both = totals.select(*VALUE_KEY, "value_added", "documents").unionByName(change)
    merged = both.groupBy(*VALUE_KEY).agg(
        F.sum("value_added").cast("decimal(19,2)").alias("value_added"), F.sum("documents").alias("documents")
    )
    return merged.where("documents <> 0")


def value_counted(
    docs: DataFrame, registry: DataFrame, munis: DataFrame, home: str = K.HOME_STATE
) -> DataFrame:
    """``value_added`` with the number of documents in each total; ``__sign`` of a document says how it counts.

    ``docs`` carries entry_id / exit_id (registry rows) and entry_muni / exit_muni. Both
    directions come from one scan. State and municipality depend only on the registry row and the
    document municipality, so the value is summed by those first and the lookups join a small
    side. ``registry`` has (id, reg, muni, state), ``munis`` has (muni, state).
    """
    a = F.col("appropriation")
    side = lambda name, code: F.when(
        a.isin("A", code),
        F.struct(
            F.lit(code).alias("direction"),
            F.col(f"{name}_id").alias("id"),
            F.col(f"{name}_muni").alias("doc_muni"),
        ),
    )
    counted = docs.where(F.col("reason").isNull() & a.isin("A", "E", "S")).select(
        "doc_type", "period", (F.col("value_added") * F.col("__sign")).alias("value_added"), "__sign",
        F.explode(F.array_compact(F.array(side("exit", "S"), side("entry", "E")))).alias("s"),
    )
    early = counted.groupBy(
        "doc_type", "period", F.col("s.direction").alias("direction"), F.col("s.id").alias("id"),
        F.col("s.doc_muni").alias("doc_muni"),
    ).agg(F.sum("value_added").alias("value_added"), F.sum("__sign").alias("documents"))
    reg = registry.select(
        "id", "reg", F.col("muni").alias("reg_muni"), F.col("state").alias("reg_state")
    )
    mun = munis.select(F.col("muni").alias("doc_muni"), F.col("state").alias("doc_state"))
    placed = early.join(reg, "id", "left").join(mun, "doc_muni", "left")
    state = F.coalesce("reg_state", "doc_state")
    return (
        placed.where(state == home)
        .groupBy(
            "doc_type", "period", "direction", F.coalesce("reg", F.lit(0)).alias("reg"),
            F.coalesce("reg_muni", "doc_muni").alias("muni"),
        )
        .agg(F.sum("value_added").cast("decimal(19,2)").alias("value_added"), F.sum("documents").alias("documents"))
    )


def municipal_index(va: DataFrame, munis: DataFrame, home: str = K.HOME_STATE) -> DataFrame:
    """Participation of each municipality per year.

    Exit minus entry per taxpayer and parent municipality, floored at zero, summed, and divided
    by the state's total with 18 digits cut off, not rounded.
    """
    return with_shares(place_values(va, munis, home))


def refreshed_index(
    index: DataFrame, totals: DataFrame, change: DataFrame, munis: DataFrame, home: str = K.HOME_STATE
) -> DataFrame:
    """The years of ``change`` of an index again, from merged totals; other years are not in the result.

    Only municipalities in which a total changed are summed again; the others keep their value, and all of
    the year get a share of the new sum of the state.
    """
    year = F.floor(F.col("period") / 100).cast("int").alias("year")
    home_ = munis.where(F.col("state") == home).select("muni", F.coalesce("parent", "muni").alias("place"))
    touched = change.join(home_, "muni").select(year, "place").distinct()
    mine = totals.join(home_, "muni").select(*VALUE_KEY, "value_added", year, "place")
    again = place_values(mine.join(touched, ["year", "place"], "left_semi").select(*VALUE_KEY, "value_added"), munis, home)
    old = index.select("year", F.col("muni").alias("place"), "va_muni")
    kept = old.join(touched.select("year").distinct(), "year", "left_semi").join(touched, ["year", "place"], "left_anti")
    return with_shares(kept.unionByName(again))


def place_values(va: DataFrame, munis: DataFrame, home: str) -> DataFrame:
    """Value of each parent municipality (place) and year."""
    mun = munis.where(F.col("state") == home).select(
        "muni", F.coalesce("parent", "muni").alias("place")
    )
    sign = F.when(F.col("direction") == "E", -F.col("value_added")).when(
        F.col("direction") == "S", F.col("value_added")
    )
    net = (
        va.join(mun, "muni")
        .groupBy((F.floor(F.col("period") / 100)).cast("int").alias("year"), "place", "reg")
        .agg(F.coalesce(F.sum(sign), F.lit(0)).alias("net"))
    )
    return net.groupBy("year", "place").agg(
        F.sum(F.greatest("net", F.lit(0))).cast("decimal(20,2)").alias("va_muni")
    )


def with_shares(by_place: DataFrame) -> DataFrame:
    # One row per municipality and year is left, so the yearly total may use a window.
    with_total = by_place.withColumn(
        "va_state", F.sum("va_muni").over(W.partitionBy("year")).cast("decimal(20,2)")
    )
    return with_total.select(
        "year",
        F.col("place").alias("muni"),
        "va_muni",
        "va_state",
        share("va_muni", "va_state").alias("share"),
    )


def share(part: str, whole: str):
    """part / whole cut (not rounded) to 18 digits, times 100.

    Decimal division would round, so whole cents are scaled by 10^18 and divided as integers.
    """
    cents = lambda c: (F.col(c) * 100).cast("decimal(19,0)")
    scaled = cents(part) * F.lit(10**18).cast("decimal(19,0)")
    digits = F.call_function("div", scaled, F.nullif(cents(whole), F.lit(0)))
    # 10^-18 * 100: sixteen places are left of the eighteen.
    places = F.lit("0.0000000000000001").cast("decimal(16,16)")
    return (digits.cast("decimal(19,0)") * places).cast("decimal(22,18)")
