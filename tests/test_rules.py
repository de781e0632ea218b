"""Decision tables and scalar functions."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes, dates, params, rules
from apportia.operators import rollups
from apportia.plans import telecom, transport

NORMAL, SIMPLE, RURAL, GONE, BLANK = ("1", "2", False), ("1", "4", False), ("1", "3", True), ("3", "2", False), (None, None, None)


@pytest.mark.parametrize(
    "entry, exit_, want",
    [
        (NORMAL, NORMAL, "A"), (NORMAL, SIMPLE, "E"), (NORMAL, GONE, "E"), (SIMPLE, NORMAL, "S"), (SIMPLE, SIMPLE, "N"),
        (SIMPLE, GONE, "N"), (GONE, NORMAL, "S"), (GONE, SIMPLE, "N"), (GONE, GONE, "N"), (RURAL, NORMAL, "A"),
        (RURAL, SIMPLE, "E"), (SIMPLE, RURAL, "S"), (RURAL, RURAL, "A"), (BLANK, NORMAL, "S"), (NORMAL, BLANK, "E"),
        (BLANK, BLANK, "N"), (("1", None, None), GONE, "E"),
    ],
)
def test_appropriation(spark, entry, exit_, want):
    lits = lambda side: (F.lit(side[0]).cast("string"), F.lit(side[1]).cast("string"), F.lit(side[2]).cast("boolean"))
    got = spark.range(1).select(rules.appropriation(lits(entry), lits(exit_))).first()[0]
    assert got == want


def test_both_parties_out_reads_null_as_unregistered(spark):
    df = spark.createDataFrame(
        [("1", "2", "3", "2"), ("1", "4", "3", "2"), (None, None, None, None), ("1", "2", "1", "5")], "a string, b string, c string, d string"
    )
    got = [r[0] for r in df.select(rules.both_parties_out(("a", "b"), ("c", "d"))).collect()]
    assert got == [False, True, True, False]


def values(spark, exprs, data, ddl):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*exprs).collect()]


def test_codes(spark):
    got = values(spark, [codes.op_code("c"), codes.product_code("c")], [("510",), ("5.101",), ("51012",), ("12",), ("0101.21.00",), ("x",), (None,), ("1234567890",)], "c string")
    assert got == [
        ("0510", "00000510"), ("5101", "00005101"), ("5101", "00051012"), ("12", "00000012"), ("0101", "01012100"),
        ("", None), (None, None), ("1234", "12345678"),
    ]


def test_money(spark):
    raw = [("1.234,56",), ("R$ 5",), ("",), ("1,5",), ("1.5",), ("x",), (None,)]
    got = values(spark, [codes.money("c"), codes.money("c", "thousands")], raw, "c string")
    assert got == [
        (D("1234.56"), D("1234.56")), (D("5.00"), D("5.00")), (None, None), (D("1.50"), D("15.00")), (D("1.50"), D("1.50")),
        (None, None), (None, None),
    ]


def test_dates(spark):
    raw = [("2021-12-29",), ("29122021",), ("20211229",), ("29/12/2021",), ("nope",), (None,)]
    got = [str(r[0]) for r in values(spark, [dates.parse_ledger_date("c")], raw, "c string")]
    assert got == ["2021-12-29"] * 4 + ["None", "None"]
    raw = [("20240131",), ("20240131235959",), ("1706659200",), ("1706659200000",), ("2024-01-31",), ("?",)]
    got = [str(r[0]) for r in values(spark, [dates.coerce_date("c")], raw, "c string")]
    assert got == ["2024-01-31"] * 5 + ["None"]


def test_windows_agree(spark):
    """A mixed column selects what the two separate columns select."""
    df = spark.sql("select explode(sequence(timestamp'2023-12-30', timestamp'2024-02-02', interval 7 hours)) as t")
    df = df.select("t", F.unix_timestamp("t").alias("e"), F.date_format("t", "yyyyMMddHHmmss").cast("bigint").alias("n"))
    w = ("2024-01-01 00:00:00", "2024-01-31 23:59:59")
    want = df.where(dates.between("t", *w)).count()
    assert want == df.where(dates.between_epoch("e", *w)).count() == df.where(dates.between_mixed("e", *w)).count()
    assert want == df.where(dates.between_mixed("n", *w)).count() == df.where(dates.between_days("t", "2024-01-01", "2024-01-31")).count()


def test_tax_numbers(spark):
    got = values(spark, [codes.padded_tax_number("c")], [("12345678000195",), ("1234567890",), ("345678000195",), ("",), ("99012345678000195",)], "c string")
    assert [g[0] for g in got] == ["12345678000195", "01234567890", "00345678000195", None, "12345678000195"]


def test_params(spark):
    assert params.coerce(" sim ") is True and params.coerce("1,5") == 1.5 and params.coerce("a, b") == ["a", "b"]
    assert params.coerce('{"a": 1}') == {"a": 1} and params.coerce("x") == "x" and params.coerce(None) is None
    assert params.coerce("7", "int") == 7
    with pytest.raises(ValueError):
        params.coerce("perhaps", "bool")
    df = spark.createDataFrame([("use_x", ""), ("USE_X", "nao"), ("N", "3")], "name string, value string")
    assert params.switches(df, {"USE_X": True, "N": 1, "OTHER": "d"}) == {"USE_X": False, "N": 3, "OTHER": "d"}


def test_fuel_value(spark):
    v = rules.fuel_item_value("f", "g", substituted="s", retained="r")
    got = values(spark, [v], [("320101", 10, 2, 1), ("120101", 10, 2, 1), (None, 10, None, 1)], "f string, g int, s int, r int")
    assert [g[0] for g in got] == [D("13.00"), D("10.00"), D("10.00")]


SPLIT = "k string, value_added decimal(17,2), code_participates boolean"


def settled(df, reasons=(), **kw):
    out = rollups.settle(df, list(reasons), **kw)
    return {r["k"]: (r["value_in"], r["value_out"], r["reason"]) for r in out.collect()}


def test_participation_split(spark):
    data = [
        ("all in", D(5), True), ("all in", D(6), True), ("all out", D(5), False), ("mixed", D(5), True), ("mixed", D(3), False),
        ("cancels out", D(5), True), ("cancels out", D(-5), True), ("cancelled", D(5), True), ("out and gone", D(4), True),
    ]
    split = rollups.participation_split(spark.createDataFrame(data, SPLIT), "k")
    split = split.withColumns({"gone": F.col("k").isin("cancelled", "out and gone"), "out": F.col("k") == "out and gone"})
    got = settled(split, [(F.col("gone"), K.CANCELLED), (F.col("out"), K.PARTIES_OUT)])
    assert got == {
        "all in": (D(11), D(0), None), "all out": (D(0), D(5), 12), "mixed": (D(5), D(3), None), "cancels out": (D(0), D(0), 12),
        "cancelled": (D(0), D(5), 10), "out and gone": (D(0), D(4), 11),
    }


def test_split_keeps_the_total(spark):
    data = [(str(i % 7), D(i), i % 3 == 0) for i in range(200)]
    split = rollups.participation_split(spark.createDataFrame(data, SPLIT), "k")
    out = rollups.settle(split, [(F.col("k") == "1", 10)])
    assert out.agg(F.sum(F.col("value_in") + F.col("value_out"))).first()[0] == sum(range(200))


def test_telecom_cancelled_reports_no_item(spark):
    data = [("a", "5101", "S", D(5)), ("b", "5101", "N", D(5)), ("c", "9999", "N", D(5))]
    items = spark.createDataFrame(data, "k string, op_code string, situation string, value_added decimal(17,2)")
    codes_ = spark.createDataFrame([("5101",)], "code string")
    got = {r["k"]: r["reason"] for r in telecom.run(items, codes_, ["k"]).collect()}
    assert got == {"a": 12, "b": None, "c": 12}


def test_transport_reasons(spark):
    data = [
        ("ok", D(9), "0", None, D(9), True), ("short", D(8), "0", "0", D(9), True), ("replaced", D(9), "0", "x", D(9), True),
        ("annulled", D(9), "x", "0", D(9), True), ("code", D(9), "0", "0", D(9), False),
    ]
    df = spark.createDataFrame(data, "k string, value_added decimal(17,2), annulment_key string, substitute_key string, received decimal(17,2), code_participates boolean")
    got = {r["k"]: r["reason"] for r in transport.settle(df, "k").collect()}
    assert got == {"ok": None, "short": 14, "replaced": 13, "annulled": 10, "code": 12}
