"""Running measures, as-of joins, validity and replay."""

import random
import re
from datetime import date, datetime, timedelta

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apportia.operators import history, joins, spans
from apportia.operators.spans import Measure

T = datetime


def test_spans_equal_plain_windows(spark):
    """One group holds most rows; every measure equals the window over the whole group."""
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.7 else str(rnd.randrange(5)), i, rnd.choice([None, rnd.random()])) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, n int, v double")
    measures = {
        "s": Measure(F.lit(1), "sum"), "m": Measure(F.col("v"), "max", inclusive=False), "f": Measure(F.col("v"), "last"),
        "b": Measure(F.col("v"), "last", inclusive=False, reverse=True),
    }
    got = spans.running(df, ["k"], ["n"], spans.number_span("n", 97), measures)
    w = W.partitionBy("k").orderBy("n")
    want = df.select(
        "*", F.count("*").over(w).alias("s"), F.max("v").over(w.rowsBetween(W.unboundedPreceding, -1)).alias("m"),
        F.last("v", True).over(w).alias("f"), F.first("v", True).over(w.rowsBetween(1, W.unboundedFollowing)).alias("b"),
    )
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def registry(spark, rows):
    return spark.createDataFrame(rows, "state string, reg bigint, valid_from timestamp, valid_to timestamp, muni int")


def at(df, **kw):
    out = joins.as_of(df, kw.pop("registry"), {"state": "state", "reg": "reg"}, "t", "valid_from", "valid_to", {"muni": "muni"}, ["muni"], **kw)
    return {r["d"]: r["muni"] for r in out.collect()}


def test_as_of_boundaries(spark):
    reg = registry(
        spark,
        [
            ("GO", 1, T(2024, 1, 1), T(2024, 1, 31, 23, 59, 59), 10), ("GO", 1, T(2024, 2, 1), None, 20),
            ("GO", 2, T(2024, 1, 1), T(2024, 12, 31), 1), ("GO", 2, T(2024, 3, 1), T(2024, 3, 31), 2), ("SP", 1, T(2020, 1, 1), None, 99),
            ("GO", None, T(2020, 1, 1), None, 77),
        ],
    )
    docs = spark.createDataFrame(
        [
            ("start", "GO", 1, T(2024, 1, 1)), ("end", "GO", 1, T(2024, 1, 31, 23, 59, 59)), ("gap", "GO", 1, T(2024, 1, 31, 23, 59, 59, 5)),
            ("open", "GO", 1, T(2030, 1, 1)), ("before", "GO", 1, T(2023, 1, 1)), ("inner", "GO", 2, T(2024, 3, 15)), ("after inner", "GO", 2, T(2024, 6, 1)),
            ("no key", "GO", None, T(2024, 1, 1)), ("no time", "GO", 1, None), ("unknown", "GO", 9, T(2024, 1, 1)),
        ],
        "d string, state string, reg bigint, t timestamp",
    )
    want = {
        "start": 10, "end": 10, "gap": None, "open": 20, "before": None, "inner": 2, "after inner": 1, "no key": None, "no time": None, "unknown": None,
    }
    assert at(docs, registry=reg) == want
    # Any window gives the same rows: months outside it are read as its first or last.
    for window in (("2024-01-01", "2024-12-31"), ("2024-03-01", "2024-03-31"), ("2019-01-01", "2019-02-01"), ("2040-01-01", "2041-01-01")):
        assert at(docs, registry=reg, window=window) == want


def test_as_of_sends_no_listed_registry_to_the_driver(spark, tmp_path):
    """A registry that is small on disk, its versions open for years: listed along a window it is many times as long."""
    rows_ = [("GO", i, T(1990, 1, 1), None, i % 7) for i in range(50)]
    registry(spark, rows_).write.parquet(str(tmp_path / "registry"))
    reg = spark.read.parquet(str(tmp_path / "registry"))
    docs = spark.createDataFrame([(str(i), "GO", i, T(1992 + i % 11, 5, 1)) for i in range(55)], "d string, state string, reg bigint, t timestamp")
    out = joins.as_of(
        docs, reg, {"state": "state", "reg": "reg"}, "t", "valid_from", "valid_to", {"muni": "muni"}, [], ("1992-01-01", "2002-12-31"), disjoint=True
    )
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["d"]: r["muni"] for r in out.collect()} == {str(i): i % 7 if i < 50 else None for i in range(55)}


def test_as_of_equals_brute_force(spark):
    rnd = random.Random(5)
    base = T(2024, 1, 1)
    versions = []
    for i in range(120):
        s = base + timedelta(days=rnd.randrange(60))
        versions.append(("GO", rnd.randrange(3), s, rnd.choice([None, s + timedelta(days=rnd.randrange(0, 12))]), i))
    docs = [(str(i), "GO", rnd.randrange(4), base + timedelta(hours=rnd.randrange(24 * 70))) for i in range(300)]

    def best(reg, t):
        live = [v for v in versions if v[1] == reg and v[2] <= t and (v[3] is None or t <= v[3])]
        return max(live, key=lambda v: (v[2], v[3] or T(9999, 1, 1), v[4]))[4] if live else None

    df = spark.createDataFrame(docs, "d string, state string, reg bigint, t timestamp")
    got = at(df, registry=registry(spark, versions), window=("2024-01-01", "2024-03-31"))
    assert got == {d: best(reg, t) for d, _, reg, t in docs}


def test_without_overlaps_leaves_no_overlap(spark):
    rows_ = [("GO", 1, T(2024, 1, d), T(2024, 1, min(d + n, 31)), d) for d, n in ((1, 20), (3, 2), (3, 9), (15, 1), (25, 3))]
    out = joins.without_overlaps(registry(spark, rows_), ["state", "reg"], "valid_from", "valid_to", ["muni"])
    found = sorted((r["valid_from"], r["valid_to"]) for r in out.collect())
    assert all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_many_open_versions_stay_linear(spark):
    """20,000 versions of one party that all overlap: nested ones and ones that end in the order of their starts."""
    n, base = 10_000, T(2024, 1, 1)
    day = timedelta(minutes=1)
    nested = [("GO", 1, base + i * day, base + (4 * n - i) * day, i) for i in range(n)]
    rolling = [("GO", 2, base + i * day, base + (n + 2 * i) * day, i) for i in range(n)]
    reg = registry(spark, nested + rolling)
    out = joins.without_overlaps(reg, ["state", "reg"], "valid_from", "valid_to", ["muni"]).cache()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not re.search(r"Join[^\n]*[<>]=? ", plan)
    got = sorted((r.reg, r.valid_from, r.valid_to, r.muni) for r in out.collect())
    one = [r for r in got if r[0] == 1]
    two = [r for r in got if r[0] == 2]
    tick = timedelta(microseconds=1)
    # Nested: each is in force until the next starts, and again from the end of the next on.
    up = [(1, base + i * day, base + (i + 1) * day - tick, i) for i in range(n - 1)] + [(1, base + (n - 1) * day, base + (3 * n + 1) * day, n - 1)]
    down = [(1, base + (4 * n - i - 1) * day + tick, base + (4 * n - i) * day, i) for i in range(n - 1)]
    assert one == sorted(up + down)
    # Rolling: from the start of the last on, it stays to the end; earlier ones end before it.
    assert [r[3] for r in two if r[1] < base + n * day][: n] == list(range(n)) and {r[3] for r in two if r[1] >= base + n * day} <= {n - 1}
    assert max(r[2] for r in two) == base + (n + 2 * (n - 1)) * day


def test_daily_versions(spark, rows):
    data = [
        (1, T(2024, 1, 1, 8), "a"), (1, T(2024, 1, 1, 9), "b"), (1, T(2024, 1, 2, 9), "b"), (1, T(2024, 1, 3, 9), None), (1, T(2024, 1, 4, 9), None),
        (1, T(2024, 1, 5, 9), "c"), (2, T(2024, 1, 1), "z"),
    ]
    df = spark.createDataFrame(data, "reg int, at timestamp, v string")
    got = rows(history.daily_versions(df, ["reg"], "at", ["v"], "start", "stop"))
    assert got == sorted(
        [
            (1, T(2024, 1, 1), T(2024, 1, 2, 23, 59, 59), "b"), (1, T(2024, 1, 3), T(2024, 1, 4, 23, 59, 59), None), (1, T(2024, 1, 5), None, "c"),
            (2, T(2024, 1, 1), None, "z"),
        ],
        key=lambda t: [(v is not None, str(v)) for v in t],
    )


def test_drop_contained(spark):
    data = [
        (1, "outer", date(2024, 1, 1), date(2024, 12, 31), 1), (1, "nested", date(2024, 2, 1), date(2024, 3, 1), 2), (1, "equal", date(2024, 1, 1), date(2024, 12, 31), 0),
        (1, "touching", date(2024, 12, 31), date(2025, 2, 1), 3), (1, "open", date(2025, 1, 1), None, 4), (1, "in open", date(2026, 1, 1), date(2026, 2, 1), 5),
        (2, "alone", date(2024, 1, 1), None, 6), (3, "no start", None, date(2024, 1, 1), 7),
    ]
    df = spark.createDataFrame(data, "reg int, name string, start date, stop date, n int")
    got = {r["name"] for r in history.drop_contained(df, "reg", "start", "stop", "n").collect()}
    assert got == {"outer", "touching", "open", "alone", "no start"}


def test_regime_changes(spark, rows):
    data = [(1, date(2024, 1, 1), date(2024, 1, 31), 1), (1, date(2024, 2, 1), date(2024, 2, 28), 2), (1, date(2024, 5, 1), None, 3)]
    df = spark.createDataFrame(data, "reg int, start date, stop date, n int")
    got = rows(history.regime_changes(df, "reg", "start", "stop", "n"), "at", "regime")
    assert got == [(date(2024, 1, 1), "3"), (date(2024, 2, 29), "2"), (date(2024, 5, 1), "3")]


LOG = "reg bigint, at timestamp, attr string, old string, seq bigint, activities bigint"


def test_replay(spark, rows):
    now = spark.createDataFrame([(1, "now", "m9", 2), (2, "idle", "m1", 0)], "reg bigint, status string, muni string, activities bigint")
    log = spark.createDataFrame(
        [
            (1, T(2024, 1, 1), "status", "s0", 1, None), (1, T(2024, 2, 1), "muni", "m1", 2, None), (1, T(2024, 3, 1), "status", "s1", 3, None),
            (1, T(2024, 3, 1), "muni", None, 4, None), (1, T(2024, 4, 1), "activity", None, 5, -1),
        ],
        LOG,
    )
    got = rows(history.replay(now, log, "reg", "at", ["status", "muni"], "2024-06-01 00:00:00", ["activities"]))
    assert got == [
        (1, T(2024, 1, 1), "s1", "m1", 1), (1, T(2024, 2, 1), "s1", None, 1), (1, T(2024, 3, 1), "now", "m9", 1), (1, T(2024, 4, 1), "now", "m9", 2),
        (2, T(2024, 6, 1), "idle", "m1", 0),
    ]


def test_activity_ledger_december(spark, rows):
    data = [(1, "a", 60.0, 202401, 202412), (1, "b", 40.0, 0, None), (1, "c", 5.0, None, 0)]
    df = spark.createDataFrame(data, "reg int, code string, percent double, s int, e int")
    got = rows(history.activity_ledger(df, "reg", "code", "percent", "s", "e"), "code", "at", "percent")
    assert got == [
        ("a", date(2024, 1, 1), 60.0), ("a", date(2025, 1, 1), -60.0), ("b", date(1900, 1, 1), 40.0), ("c", date(1900, 1, 1), 5.0),
    ]
    rural = spark.createDataFrame([("a",)], "code string")
    ledger = history.activity_ledger(df, "reg", "code", "percent", "s", "e")
    flags = rows(history.rural_by_month(ledger, rural, "reg", "code", ["2024-06-01", "2025-02-01"]), "month", "rural", "rural_only")
    assert flags == [(date(2024, 6, 1), True, False)]


def test_window_changes(spark):
    data = [(1, T(2023, 1, 1)), (1, T(2023, 6, 1)), (1, T(2024, 1, 15)), (1, T(2025, 1, 1)), (2, T(2025, 1, 1)), (2, T(2026, 1, 1))]
    df = spark.createDataFrame(data, "reg int, at timestamp")
    got = {tuple(r) for r in history.changes_for_window(df, "reg", "at", "2024-01-01 00:00:00", "2024-01-31 00:00:00").collect()}
    assert got == {(1, T(2023, 6, 1)), (1, T(2024, 1, 15)), (2, T(2025, 1, 1))}


def test_in_period_overlap_gives_two_rows(spark):
    docs = spark.createDataFrame([("a", date(2024, 1, 31)), ("b", date(2024, 3, 1)), ("c", None)], "d string, day date")
    periods = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 1, 31), date(2024, 2, 2))], "start date, stop date")
    got = sorted((r["d"], r["in_period"]) for r in joins.in_period(docs, periods, "day", "start", "stop").collect())
    assert got == [("a", True), ("a", True), ("b", False), ("c", False)]
