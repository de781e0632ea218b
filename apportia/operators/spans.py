"""Running measures over ordered groups that never sit whole in one task.

A plain window over a registration sends all its rows to one task. Here every group is cut into
time or number spans that follow the order, the window runs inside a span, and one summary row
per span carries the state forward. The row data is shuffled once, by group and span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apportia.functions.codes import col


@dataclass(frozen=True)
class Measure:
    """``kind`` is max, sum or last (last non-null); ``inclusive`` counts the current row.

    ``reverse`` runs from the end of the group towards its start.
    """

    value: Column
    kind: str
    inclusive: bool = True
    reverse: bool = False


_SPAN = "__span"
_GROUP = "__group"
_CARRY = "__carry"


def running(
    df: DataFrame, keys: list[str], order: list[str], span: Column, measures: dict[str, Measure]
) -> DataFrame:
    """Add running measures.

    ``order`` must be total and ``span`` must not decrease along it, null before all others. Null keys are
    a group like others: keys and span are held in structs, which compare by plain equality, nulls
    included, so that the carry join keeps the partitioning of the window.
    """
    def along(cols: list[str], reverse: bool) -> list[Column]:
        return [F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first() for c in cols]

    cut = df.withColumn(_SPAN, F.struct(span)).withColumn(_GROUP, F.struct(*keys))
    local = cut
    for name, m in measures.items():
        last_row = W.currentRow if m.inclusive else -1
        in_span = W.partitionBy(_GROUP, _SPAN).orderBy(*along(order, m.reverse))
        local = local.withColumn(name, _over(m, in_span.rowsBetween(W.unboundedPreceding, last_row)))

    place = F.struct(*[F.col(c) for c in order])
    summary = cut.groupBy(_GROUP, _SPAN).agg(
        *[_summary(m, place).alias(f"{_CARRY}_{name}") for name, m in measures.items()]
    )

    def before(reverse: bool):
        w = W.partitionBy(_GROUP).orderBy(*along([_SPAN], reverse))
        return w.rowsBetween(W.unboundedPreceding, -1)

    right = summary.select(
        F.col(_GROUP).alias("__k_group"),
        F.col(_SPAN).alias("__k_span"),
        *[
            _over(Measure(F.col(f"{_CARRY}_{n}"), m.kind), before(m.reverse)).alias(f"{_CARRY}_{n}")
            for n, m in measures.items()
        ],
    )
    on = [F.col(_GROUP) == F.col("__k_group"), F.col(_SPAN) == F.col("__k_span")]
    joined = local.join(right, on, "left")
    return joined.select(
        *df.columns,
        *[_merge(m.kind, F.col(n), F.col(f"{_CARRY}_{n}")).alias(n) for n, m in measures.items()],
    )


def _over(m: Measure, frame) -> Column:
    if m.kind == "max":
        return F.max(m.value).over(frame)
    if m.kind == "sum":
        return F.sum(m.value).over(frame)
    return F.last(m.value, ignorenulls=True).over(frame)


def _summary(m: Measure, place: Column) -> Column:
    if m.kind == "max":
        return F.max(m.value)
    if m.kind == "sum":
        return F.sum(m.value)
    at = F.when(m.value.isNotNull(), place)
    return F.min_by(m.value, at) if m.reverse else F.max_by(m.value, at)


def _merge(kind: str, local: Column, carry: Column) -> Column:
    if kind == "max":
        return F.greatest(local, carry)
    if kind == "sum":
        return F.coalesce(local + carry, local, carry)
    return F.coalesce(local, carry)


def day_span(c: str) -> Column:
    return F.to_date(c)


def month_span(c: str) -> Column:
    return F.trunc(F.col(c), "month")


def number_span(c: str, width: int = 1024) -> Column:
    return F.floor(F.col(c) / width)


def position(df, keys, order, span, name="position") -> DataFrame:
    """Running number within the group, from 1."""
    return running(df, keys, order, span, {name: Measure(F.lit(1).cast("bigint"), "sum")})


def previous_row(df, keys, order, span, cols: list[str], name="previous") -> DataFrame:
    """Struct of the previous row's columns, null on the first row of the group."""
    row = F.struct(*[F.col(c) for c in cols])
    return running(df, keys, order, span, {name: Measure(row, "last", inclusive=False)})


def next_row(df, keys, order, span, cols: list[str], name="following") -> DataFrame:
    return running(df, keys, order, span, {name: following(cols)})


def following(cols: list[str]) -> Measure:
    """The next row's columns, as a measure."""
    return Measure(F.struct(*[F.col(c) for c in cols]), "last", inclusive=False, reverse=True)


def forward_fill(df, keys, order, span, cols: list[str]) -> DataFrame:
    """Replace nulls by the last value seen in the group."""
    filled = running(
        df, keys, order, span, {f"__fill_{c}": Measure(F.col(c), "last") for c in cols}
    )
    return filled.select(
        *[F.col(f"__fill_{c}").alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def group_total(df, keys, totals: dict[str, Column]) -> DataFrame:
    """Group totals on every row, summed before the rows are shuffled."""
    sums = df.groupBy(*keys).agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    right = sums.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *totals)
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(right, on, "left").select(*df.columns, *totals)


def best_row(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Row with the greatest order value per key, reduced before the shuffle.

    Works for any row type; ``order`` must end in a total tie-break.
    """
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*[col(o) for o in order])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)
