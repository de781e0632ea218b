"""Dates, periods and window predicates (Column -> Column)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from apportia.functions.codes import col

# Layouts of ledger dates, tried in this order.
LEDGER_LAYOUTS = ("yyyy-MM-dd", "ddMMyyyy", "yyyyMMdd", "dd/MM/yyyy")


def parse_ledger_date(c: Column | str) -> Column:
    return F.coalesce(*[F.try_to_date(col(c), layout) for layout in LEDGER_LAYOUTS])


def coerce_timestamp(c: Column | str) -> Column:
    """Time from a number or a text.

    The count of digits tells what a number is: 8 or 14 are a calendar date or time, filled up to the
    second; 13 and more are milliseconds, all others seconds since 1970. Other text is parsed.
    """
    told = F.trim(col(c).cast("string"))
    count = F.when(told.rlike(r"^\d+$"), F.length(told)).otherwise(0)
    calendar = F.try_to_timestamp(F.rpad(told, 14, "0"), F.lit("yyyyMMddHHmmss"))
    unit = F.when(count < 13, 1_000_000).otherwise(1_000).cast("bigint")
    since_1970 = F.timestamp_micros(F.try_multiply(told.try_cast("bigint"), unit))
    return F.when(count.isin(8, 14), calendar).when(count > 0, since_1970).otherwise(told.try_cast("timestamp"))


def coerce_date(c: Column | str) -> Column:
    return F.to_date(coerce_timestamp(c))


def date_from_number(c: Column | str) -> Column:
    """yyyyMMdd as a number, 0 meaning open."""
    return F.when(col(c) != 0, F.try_to_date(col(c).cast("string"), "yyyyMMdd"))


def from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c).cast("bigint"))


def period(c: Column | str) -> Column:
    """yyyyMM as an integer."""
    return F.year(col(c)) * 100 + F.month(col(c))


def period_start(c: Column | str) -> Column:
    p = col(c).cast("int")
    return F.make_date(F.floor(p / 100).cast("int"), (p % 100).cast("int"), F.lit(1))


def next_month_start(c: Column | str) -> Column:
    return F.add_months(F.trunc(col(c), "month"), 1)


def month_end(c: Column | str) -> Column:
    return F.last_day(col(c))


def add_days(c: Column | str, days: int, seconds: int = 0) -> Column:
    """Calendar days on the wall clock, whatever the session's time zone."""
    return col(c).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(days), secs=F.lit(seconds))


def between(c: Column | str, first, last) -> Column:
    """Closed window on a typed column, in the form Parquet filters push down."""
    return col(c).between(F.lit(first), F.lit(last))


def between_days(c: Column | str, first: str, last: str) -> Column:
    """Both days whole. Text bounds take the column's own type, so they reach the scan."""
    after = date.fromisoformat(last) + timedelta(days=1)
    return (col(c) >= F.lit(f"{first} 00:00:00")) & (col(c) < F.lit(f"{after} 00:00:00"))


def between_epoch(c: Column | str, first: str, last: str) -> Column:
    """Closed window on an epoch-second column; the bounds fold to literals."""
    low = F.unix_timestamp(F.lit(first).cast("timestamp"))
    high = F.unix_timestamp(F.lit(last).cast("timestamp"))
    return (col(c) >= low) & (col(c) <= high)


def between_mixed(c: Column | str, first: str, last: str) -> Column:
    """Window on a number holding epoch seconds (up to 10 digits) or yyyyMMddHHmmss (12 or more).

    The two ranges cannot meet, so a pair of plain comparisons replaces a test of the length and
    both still reach the scan.
    """
    v = col(c)
    low, high = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    stamp = lambda t: F.date_format(t, "yyyyMMddHHmmss").cast("bigint")
    epoch = (v >= F.unix_timestamp(low)) & (v <= F.least(F.unix_timestamp(high), F.lit(9999999999)))
    wide = (v >= F.greatest(stamp(low), F.lit(100000000000))) & (v <= stamp(high))
    return epoch | wide


def overlaps(start: Column | str, stop: Column | str, first, last) -> Column:
    """Interval [start, stop] meets the window [first, last]."""
    return (col(start) <= F.lit(last)) & (col(stop) >= F.lit(first))


def covers(start: Column | str, stop: Column | str, first, last) -> Column:
    """Validity covers the whole window; an open end always reaches it."""
    return (col(start) <= F.lit(first)) & (col(stop).isNull() | (col(stop) >= F.lit(last)))


def valid_at(at: Column | str, start: Column | str, stop: Column | str) -> Column:
    return (col(start) <= col(at)) & (col(stop).isNull() | (col(at) <= col(stop)))
