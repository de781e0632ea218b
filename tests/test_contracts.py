"""What operators promise for nulls, ties and repeated keys, and values after a registry change."""

from datetime import datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from apportia import constants as K
from apportia.operators import sinks, spans
from apportia.plans import corrections, ticket


def test_running_carries_over_null_keys_and_spans(spark):
    data = [(g, n, v) for g in ("a", None) for n, v in ((None, 1), (1, 2), (5, None), (2000, 4), (5000, 8))]
    df = spark.createDataFrame(data, "g string, n long, v long")
    got = spans.running(
        df, ["g"], ["n"], spans.number_span("n"),
        {"sum": spans.Measure(F.col("v"), "sum"), "seen": spans.Measure(F.col("v"), "last", inclusive=False),
         "after": spans.Measure(F.col("v"), "last", inclusive=False, reverse=True)},
    )
    want = [(None, 1, None, 2), (1, 3, 1, 4), (5, 3, 2, 4), (2000, 7, 2, 8), (5000, 15, 4, None)]
    for g in ("a", None):
        rows = got.where(F.col("g").eqNullSafe(F.lit(g))).select("n", "sum", "seen", "after").collect()
        assert sorted(map(tuple, rows), key=lambda r: r[0] or 0) == want


def test_items_without_id_are_numbered_alike_on_every_run(spark):
    detail = spark.createDataFrame(
        [("k", None, None, str(i)) for i in range(40)] + [("k", 7, None, "x"), ("k", None, 3, "y")], "access_key string, trip_no int, id long, note string"
    )
    first = {r.note: r.item_no for r in ticket.number_items(detail).collect()}
    assert first == {r.note: r.item_no for r in ticket.number_items(detail.repartition(7)).collect()}
    assert sorted(first.values()) == list(range(1, 43)) and (first["y"], first["x"]) == (41, 42)


def test_updates_with_repeated_keys_add_no_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    got = sinks.update_columns(target, changes, ["k"], ["v"])
    assert sorted(map(tuple, got.collect())) == [(1, "y"), (2, "b")]


def test_value_follows_the_registry(spark):
    """A lifted exclusion regains its value, a new one loses it, cancelled and duplicate documents stay."""
    at = datetime(2024, 3, 1)
    registry = spark.createDataFrame(
        [(1, 1, "GO", datetime(2020, 1, 1), None, 9, "1", "2", False), (2, 2, "GO", datetime(2020, 1, 1), None, 9, "3", "2", False)],
        "id long, reg long, state string, valid_from timestamp, valid_to timestamp, muni int, status string, regime string, rural boolean",
    )
    docs = spark.createDataFrame(
        [(k, 1, e, "GO", x, "GO", at, D(v), r) for k, e, x, v, r in (
            ("lifted", 1, 2, "0", K.PARTIES_OUT), ("new", 2, 2, "55", None), ("cancelled", 1, 1, "0", K.CANCELLED), ("same", 1, 1, "55", None),
            ("twice", 1, 1, "7", K.DUPLICATE_OPERATION), ("no items", 1, 1, "5", None), ("out", 1, 1, "0", K.PARTIES_OUT),
        )],
        "access_key string, doc_type int, entry_reg long, entry_state string, exit_reg long, exit_state string, emitted_at timestamp, value_added decimal(17,2), reason int",
    )
    items = spark.createDataFrame(
        [(k, 1, n, code, D(v)) for k in ("lifted", "new", "cancelled", "same", "twice") for n, code, v in ((1, "5101", "50"), (2, "5102", "5"), (3, "9999", "3"))]
        + [("out", 1, 1, "9999", D("3"))],
        "access_key string, doc_type int, item_no int, op_code string, value_added decimal(17,2)",
    )
    codes = spark.createDataFrame([("5101",), ("5102",)], "code string")
    got = {r.access_key: (r.value_added, r.reason) for r in corrections.registry_changed(docs, items, codes, registry).collect()}
    assert got == {
        "lifted": (D(55), None), "new": (D(0), K.PARTIES_OUT), "cancelled": (D(0), K.CANCELLED), "same": (D(55), None),
        "twice": (D(7), K.DUPLICATE_OPERATION), "no items": (D(0), K.NO_ITEM_LEFT), "out": (D(0), K.NO_ITEM_LEFT),
    }
