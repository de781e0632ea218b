"""Pair logic, value added and index."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from apportia.operators import pairs, results, versions
from apportia.plans import corrections

ITEM = "doc string, entry_reg bigint, entry_state string, exit_reg bigint, exit_state string, op_code string, product string, gross decimal(17,2), value_added decimal(17,2)"


def item(doc, entry, exit_, code, product, gross):
    return (doc, entry, "GO", exit_, "GO", code, product, D(gross), D(gross))


def test_opposite_operations(spark):
    data = [
        item("sale", 2, 1, "5101", "1000", 10), item("return", 1, 2, "1101", "1000", 4),  # smaller entry goes
        item("a", 4, 3, "5102", "1000", 3), item("b", 3, 4, "1102", "1000", 9),  # smaller exit goes
        item("t1", 6, 5, "5101", "1000", 7), item("t2", 5, 6, "1101", "1000", 7),  # exact tie: both stay
        item("n1", 8, 7, "5949", "1000", 1), item("n2", 7, 8, "1949", "1000", 2),  # no mirrored code
        item("p1", 10, 9, "5101", "1000", 1), item("p2", 9, 10, "1101", "2000", 2),  # other product
        item("mixed", 1, 2, "1101", "1000", 2), item("mixed", 1, 2, "1949", "1000", 5),
    ]
    items = spark.createDataFrame(data, ITEM)
    excluded = pairs.opposite_operations(pairs.operation_totals(items))
    flagged, docs = pairs.exclude_opposite(items, excluded, ["doc"])
    assert {r["doc"] for r in flagged.where("duplicate").collect()} == {"return", "a", "mixed"}
    assert flagged.count() == len(data)
    got = {r["doc"]: (r["value_added"], r["reason"]) for r in docs.collect()}
    assert got == {"return": (D(0), 12), "a": (D(0), 12), "mixed": (D(5), None)}


def test_bidirectional_pairs(spark):
    rows = [(2, "GO", 1, "GO"), (1, "GO", 2, "GO"), (2, "GO", 1, "GO"), (3, "GO", 1, "GO"), (1, "SP", 3, "GO"), (5, "GO", 5, "GO")]
    docs = spark.createDataFrame(rows, "entry_reg bigint, entry_state string, exit_reg bigint, exit_state string")
    both = pairs.bidirectional_pairs(docs)
    assert [tuple(r) for r in both.collect()] == [(1, "GO", 2, "GO", 2, 1)]
    assert pairs.between_listed_pairs(docs, both).count() == 3


def test_positional_match(spark):
    left = spark.createDataFrame([("d", i) for i in (3, 1, 2)] + [("e", 1)], "doc string, item_no int")
    right = spark.createDataFrame([("d", i) for i in (10, 20)] + [("f", 1)], "doc string, item_no int")
    out = pairs.positional_match(left, right, ["doc"], ["item_no"], F.floor(F.col("item_no") / 2))
    got = {(r["doc"], r["position"], r["item_no_invoice"], r["item_no_ledger"]) for r in out.collect()}
    assert got == {("d", 1, 1, 10), ("d", 2, 2, 20), ("d", 3, 3, None), ("e", 1, 1, None), ("f", 1, None, 1)}
    items, docs = pairs.fixed_assets(out, ["doc"], "item_no")
    assert {tuple(r) for r in items.collect()} == {("d", 1, 3), ("d", 2, 3)}
    assert [tuple(r) for r in docs.collect()] == [("d", D(0), 12)]


def test_fixed_asset_exclusion(spark):
    docs = spark.createDataFrame([("i1", 10, D(9), None), ("i2", 10, D(5), None)], "access_key string, doc_type int, value_added decimal(17,2), reason int")
    items = spark.createDataFrame([("i1", 10, 1, None), ("i1", 10, 2, None), ("i2", 10, 1, 1)], "access_key string, doc_type int, item_no int, reason int")
    side = lambda rows: spark.createDataFrame(rows, "access_key string, doc_id string, doc_type int")
    matches = pairs.match_by_key(side([("k", "e1", 5)]), side([("k", "i1", 10)]), side([]), "access_key")
    inv = items.select(F.col("access_key").alias("doc_id"), "doc_type", "item_no")
    book = spark.createDataFrame([("e1", 5, 7)], "doc_id string, doc_type int, item_no int")
    new_docs, new_items = corrections.fixed_asset_exclusion(docs, items, matches, inv, book)
    assert {tuple(r) for r in new_docs.collect()} == {("i1", 10, D(0), 12), ("i2", 10, D(5), None)}
    assert {tuple(r) for r in new_items.collect()} == {("i1", 10, 1, 3), ("i1", 10, 2, None), ("i2", 10, 1, 1)}


MUNIS = "muni int, parent int, state string, name string"


def test_value_added(spark):
    docs = spark.createDataFrame(
        [
            (10, 202401, D(5), "A", None, 1, 2, 100, 200), (10, 202401, D(7), "E", None, 1, 2, 100, 200), (10, 202401, D(9), "S", 12, 1, 2, 100, 200),
            (10, 202401, D(4), "S", None, 1, None, 100, 300), (10, 202401, D(3), "N", None, 1, 2, 100, 200), (2, 202401, D(2), "S", None, 1, 2, 100, 999),
        ],
        "doc_type int, period int, value_added decimal(17,2), appropriation string, reason int, entry_id bigint, exit_id bigint, entry_muni int, exit_muni int",
    )
    reg = spark.createDataFrame([(1, 11, 101, "GO"), (2, 22, 202, "GO")], "id bigint, reg bigint, muni int, state string")
    munis = spark.createDataFrame([(100, None, "GO", ""), (200, None, "GO", ""), (300, None, "GO", "")], MUNIS)
    got = {(r["doc_type"], r["direction"], r["reg"], r["muni"]): r["value_added"] for r in results.value_added(docs, reg, munis).collect()}
    # The registry's municipality wins; a document without registry row keeps its own and has number 0.
    assert got == {(10, "S", 22, 202): D(5), (10, "E", 11, 101): D(12), (10, "S", 0, 300): D(4), (2, "S", 22, 202): D(2)}


def test_index(spark):
    va = spark.createDataFrame(
        [
            (202401, "S", 1, 10, D(5)), (202402, "E", 1, 10, D(3)), (202401, "E", 2, 10, D(50)),  # 2 is negative: floored
            (202403, "S", 3, 11, D(2)),  # district of 10
            (202401, "S", 4, 20, D(2)), (202401, "S", 5, 30, D(1000)), (202301, "S", 4, 20, D(1)),
        ],
        "period int, direction string, reg bigint, muni int, value_added decimal(19,2)",
    )
    munis = spark.createDataFrame([(10, None, "GO", ""), (11, 10, "GO", ""), (20, None, "GO", ""), (30, None, "SP", "")], MUNIS)
    got = {(r["year"], r["muni"]): (r["va_muni"], r["va_state"], r["share"]) for r in results.municipal_index(va, munis).collect()}
    assert got[(2024, 10)] == (D(4), D(6), D("66.6666666666666666"))  # cut off, not rounded up
    assert got[(2024, 20)] == (D(2), D(6), D("33.3333333333333333"))
    assert got[(2023, 20)] == (D(1), D(1), D(100)) and len(got) == 3


def test_index_of_large_values(spark):
    big = D("123456789012345.67")
    va = spark.createDataFrame([(202401, "S", 1, 1, big), (202401, "S", 2, 2, D("987654321098765.43"))], "period int, direction string, reg bigint, muni int, value_added decimal(19,2)")
    munis = spark.createDataFrame([(1, None, "GO", ""), (2, None, "GO", "")], MUNIS)
    got = {r["muni"]: r["share"] for r in results.municipal_index(va, munis).collect()}
    cents, total = 12345678901234567, 12345678901234567 + 98765432109876543
    assert got[1] == D(cents * 10**18 // total).scaleb(-16)
    assert 100 - sum(got.values()) < D("0.000000000000001")


def test_merge_validity(spark):
    ddl = "reg int, start timestamp, stop timestamp, kind string"
    from datetime import datetime as T

    stored = spark.createDataFrame(
        [(1, T(2020, 1, 1), None, "x"), (2, T(2020, 1, 1), None, "x"), (3, T(2020, 1, 1), T(2021, 1, 1), "x"), (4, T(2024, 1, 1), None, "x"), (5, T(2020, 1, 1), T(2026, 1, 1), "x")], ddl
    )
    incoming = spark.createDataFrame([(r, T(2024, 1, 1) if r != 2 else T(2020, 1, 1), None, "y") for r in (1, 2, 3, 5, 6)] + [(4, T(2023, 1, 1), None, "y")], ddl)
    changes, rejected = versions.merge_validity(stored, incoming, "reg", "kind")
    got = {(r["reg"], r["action"], r["start"], r["stop"]) for r in changes.collect()}
    assert got == {
        (1, "close", T(2020, 1, 1), T(2023, 12, 31, 23, 59, 59)), (1, "insert", T(2024, 1, 1), None), (3, "insert", T(2024, 1, 1), None),
        (6, "insert", T(2024, 1, 1), None),
    }
    assert {r["reg"] for r in rejected.collect()} == {4, 5}


def test_registry_rebuild(spark):
    from datetime import datetime as T

    current = spark.createDataFrame([(1, "3", "2", "7", 1, 1)], "reg bigint, status string, regime string, muni string, activities bigint, rural_activities bigint")
    log = spark.createDataFrame(
        [(1, T(2024, 1, 1, 5), "status", "1", 1, None, None), (1, T(2024, 3, 1, 5), "status", "1", 2, None, None)],
        "reg bigint, at timestamp, attr string, old string, seq bigint, activities bigint, rural_activities bigint",
    )
    stored = spark.createDataFrame(
        [(1, "GO", T(2024, 1, 1), T(2024, 1, 5), "1", "2", 7, True, True), (1, "GO", T(2023, 1, 1), None, "1", "2", 7, True, True), (9, "SP", T(2023, 1, 1), None, "1", "2", 7, True, True)],
        "reg bigint, state string, valid_from timestamp, valid_to timestamp, status string, regime string, muni int, rural boolean, rural_only boolean",
    )
    diff, after = corrections.rebuild_registry(stored, current, log, "2024-06-01 00:00:00")
    assert {(r["valid_from"], r["action"]) for r in diff.collect()} == {(T(2024, 1, 1), "changed"), (T(2023, 1, 1), "removed"), (T(2024, 3, 1), "added")}
    got = {(r["reg"], r["valid_from"], r["valid_to"], r["status"]) for r in after.collect()}
    assert got == {
        (1, T(2024, 1, 1), T(2024, 2, 29, 23, 59, 59), "1"), (1, T(2024, 3, 1), None, "3"), (9, T(2023, 1, 1), None, "1"),
    }
    again, _ = corrections.rebuild_registry(after, current, log, "2024-06-01 00:00:00")
    assert again.count() == 0


def test_code_lists_are_sent_and_rows_are_not_dealt_by_code(spark):
    from apportia.operators import joins
    from apportia.plans import rules as chain

    items = spark.createDataFrame([(i, "5101" if i % 9 else None) for i in range(50)] + [(50, "1949"), (51, "7")], "item_no int, op_code string")
    codes_ = spark.createDataFrame([("5101",), ("5101",), (None,)], "code string")
    flagged = joins.participation_flag(items, codes_, "op_code", "code", "ok")
    known = spark.createDataFrame([("5101", True), ("1949", None)], "code string, participates boolean")
    for out in (flagged, chain.flag_codes(items, known, "op_code", "ok")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning(op_code" not in plan
        assert {r.item_no for r in out.where("ok").collect()} == {i for i in range(50) if i % 9} and out.count() == 52


def test_ledger_pairs_of_repeated_rows_on_both_sides(spark):
    ddl = "access_key int, doc_id int, doc_type int"
    ledger = spark.createDataFrame([(1, 7, 5), (1, 7, 5), (1, 8, 5), (None, 9, 5), (3, None, 5)], ddl)
    issued = spark.createDataFrame([(1, 70, 10), (1, 70, 10), (None, 71, 10), (3, 72, 10)], ddl)
    received = spark.createDataFrame([(1, 70, 2), (1, None, 2), (4, 73, 2)], ddl)
    found = pairs.match_by_key(ledger, issued, received, "access_key")
    assert found.columns == ["access_key", "ledger_id", "ledger_type", "invoice_id", "invoice_type"]
    want = [(1, x, 5, *i) for x in (7, 8) for i in ((70, 10), (70, 2), (None, 2))] + [(3, None, 5, 72, 10)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.index("Join") < plan.index("Aggregate")
