"""Change-driven corrections, retractions and identity maps against full recomputation, with the work they did."""

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from apportia.operators import commits, joins, results, sinks, versions
from apportia.plans import corrections, store
from apportia.retail import frames as R
from apportia.retail import load_queries as L

SF = "/root/testdata/sf0.001"
T = datetime
REG = "reg int, valid_from timestamp, valid_to timestamp, v string, id int"


def test_changed_spans(spark):
    """Against each second of a line of time: null values, gaps, open ends, splits that change nothing."""
    pick, base, ends = random.Random(3), T(2024, 1, 1), 60

    def registry(seed):
        rows, r = [], random.Random(seed)
        for reg in range(12):
            at = r.randrange(3)
            while at < ends - 10:
                length = r.randrange(1, 9)
                stop = None if at + length >= ends - 12 and r.random() < 0.5 else base + timedelta(seconds=at + length)
                rows.append((reg, base + timedelta(seconds=at), stop, r.choice(["a", "b", None]), pick.randrange(9)))
                at = at + length + r.randrange(1, 4) if stop else ends
        return rows

    old, new = registry(1), registry(2)
    new = [r for r in new if r[0] != 3] + [r for r in old if r[0] in (5, 6)]
    new = [r for r in new if r[0] not in (5, 6) or r in old]
    got = versions.changed_spans(*[spark.createDataFrame(x, REG) for x in (old, new)], ["reg"], "valid_from", "valid_to", ["v"]).collect()

    def at(rows, reg, t):
        return next((("has", r[3]) for r in rows if r[0] == reg and r[1] <= t and (r[2] is None or t <= r[2])), None)

    for reg in range(12):
        for s in range(-1, 2 * ends):
            t = base + timedelta(seconds=s / 2)
            hits = [r for r in got if r.reg == reg and r.valid_from <= t and (r.valid_to is None or t <= r.valid_to)]
            assert len(hits) == (at(old, reg, t) != at(new, reg, t)), (reg, t)
    assert {r.reg for r in got}.isdisjoint({5, 6}) and any(r.valid_to is None for r in got)


def test_registry_rework_equals_full_and_touches_few(spark):
    held, out, again = L.registry_reworked(spark, SF)
    docs, items, _, now = L.registry_parts(spark, SF)
    full = corrections.registry_changed(held.select(docs.columns), items, R.codes_frame(spark), now, keys=["doc_id"])
    order = lambda f: sorted(f.select(*held.columns).collect(), key=str)
    assert order(out) == order(full)
    moved = held.alias("a").join(full.alias("b"), "doc_id").where("NOT (a.entry_id <=> b.entry_id AND a.exit_id <=> b.exit_id)").count()
    assert moved <= again.count() < held.count() / 2


def test_op_code_rework_equals_full_and_touches_few(spark):
    docs, items = L.settled_before(spark, SF)
    new = R.codes_frame(spark, (*R.COUNTED_CODES[1:], "1410"))
    full = corrections.op_codes_changed(docs, items, new)
    *parts, hit = corrections.op_codes_reworked(docs, items, R.codes_frame(spark), new)
    for got, want in zip(parts, full):
        assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)
    codes = {R.COUNTED_CODES[0], "1410"}
    assert hit.count() == items.where(F.col("op_code").isin(*codes)).select("access_key").distinct().count() < docs.count() / 2
    same = corrections.op_codes_reworked(docs, items, R.codes_frame(spark), R.codes_frame(spark))
    assert same[2].count() == 0 and same[0].count() == docs.count()


def test_totals_after_retraction(spark):
    """A group that loses its last document goes; one whose values cancel out but has documents stays."""
    munis = spark.createDataFrame([(1, None, "GO"), (2, 1, "GO"), (3, None, "SP")], "muni int, parent int, state string")
    registry = spark.createDataFrame([(i, i * 10, 1 + i % 3, "SP" if i % 3 == 2 else "GO") for i in range(6)], "id int, reg int, muni int, state string")
    pick = random.Random(4)
    make = lambda n: [(pick.choice([10, 2]), pick.choice([202301, 202302, 202401]), D(pick.randrange(-5, 50)), pick.choice("AESN"),
                       pick.choice([None, None, 11]), pick.randrange(7), pick.randrange(7), pick.choice([1, 2, 3, None]), pick.choice([1, 2, 3, None])) for _ in range(n)]
    ddl = "doc_type int, period int, value_added decimal(17,2), appropriation string, reason int, entry_id int, exit_id int, entry_muni int, exit_muni int"
    keep, gone, come = (spark.createDataFrame(make(n), ddl) for n in (60, 40, 30))
    count = lambda d: results.value_counted(d.withColumn("__sign", F.lit(1)), registry, munis, "GO")
    change = results.value_change(gone, come, registry, munis, "GO")
    got = results.merge_totals(count(keep.unionByName(gone)), change)
    want = count(keep.unionByName(come))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())
    assert results.value_change(gone, gone, registry, munis, "GO").count() == 0
    old = results.municipal_index(count(keep.unionByName(gone)), munis, "GO")
    assert sorted(results.refreshed_index(old, got, change, munis, "GO").collect()) == sorted(results.municipal_index(want, munis, "GO").collect())
    one = change.where("period = 202401")
    assert {r.year for r in results.refreshed_index(old, got, one, munis, "GO").collect()} <= {2024}


def test_identity_map_rewrites_only_buckets_with_new_keys(spark, tmp_path):
    tables = commits.Tables(spark, f"file://{tmp_path}/ids", ["bucket"])
    cols = ["a", "b"]
    keys = lambda rows: spark.createDataFrame(rows, "a string, b int")
    first = [(f"k{i % 50}", i % 7) for i in range(400)] + [(None, 1), ("x", None), (None, None)] * 3
    assert store.extend_identity_map(tables, "m", keys(first), cols, 8) == list(range(8))
    read = lambda: {(r.a, r.b): r.id for r in tables.read("m").collect()}
    before, state = read(), tables.state()
    assert set(before) == set(first) and len(set(before.values())) == len(before) == tables.read("m").count()
    assert store.extend_identity_map(tables, "m", keys(first), cols, 8) == [] and tables.state() == state
    touched = store.extend_identity_map(tables, "m", keys([*first, ("new", 1), ("new", 2), ("new", 2)]), cols, 8)
    after = read()
    assert len(touched) in (1, 2) and {k: after[k] for k in before} == before and len(set(after.values())) == len(before) + 2
    runs = lambda s: {p: run for p, run in s.tables["m"].items()}
    assert {p for p in runs(state) if runs(state)[p] != runs(tables.state())[p]} == {f"[{b}]" for b in touched}


def test_identity_map_is_dense_in_a_bucket(spark):
    keys = spark.range(100).select(F.col("id").alias("k"))
    one = sinks.extend_map(None, keys.where("k % 3 = 0"), ["k"], 4, F.col("k") % 4)
    both = sinks.extend_map(one, keys, ["k"], 4, F.col("k") % 4)
    for b in range(4):
        assert sorted(r.id for r in both.where(F.col("bucket") == b).collect()) == list(range(b, 100, 4))


@pytest.mark.parametrize("window", [None, ("2024-01-01", "2024-03-31")])
def test_as_of_after_rework_helpers(spark, window):
    """A registry whose versions do not overlap comes out as it went in."""
    rows = [("GO", 1, T(2024, 1, 1), T(2024, 1, 31), 1), ("GO", 1, T(2024, 2, 1), None, 2)]
    reg = spark.createDataFrame(rows, "state string, reg int, valid_from timestamp, valid_to timestamp, muni int")
    out = joins.without_overlaps(reg, ["state", "reg"], "valid_from", "valid_to", ["muni"])
    assert sorted(map(tuple, out.collect())) == rows
    docs = spark.createDataFrame([("GO", 1, T(2024, 2, 2))], "s string, r int, t timestamp")
    got = joins.as_of(docs, out, {"s": "state", "r": "reg"}, "t", "valid_from", "valid_to", {"muni": "m"}, [], window, disjoint=True)
    assert got.first().m == 2


def test_no_task_numbers_a_whole_bucket_of_the_identity_map(spark):
    keys = spark.range(20_000).select(F.when(F.col("id") > 9, F.col("id")).alias("k"), (F.col("id") % 2).alias("b"))
    held = sinks.extend_map(None, keys.where("k % 3 = 0"), ["k", "b"], 1, F.lit(0))
    found = sinks.extend_map(held, keys, ["k", "b"], 1, F.lit(0))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan and "Window [row_number()" in plan and "[bucket#" in plan
    assert not [x for x in plan.splitlines() if "row_number()" in x and "__range" not in x]
    rows = found.collect()
    assert sorted(r.id for r in rows) == list(range(len(rows))) and len(rows) == 19_992
    new = sorted((r.id, r.k is not None, r.k or 0, r.b) for r in rows if r.k is None or r.k % 3)
    assert [r[1:] for r in new] == sorted(r[1:] for r in new)
    by_key = {(r.k, r.b): r.id for r in rows}
    assert all(by_key[r.k, r.b] == r.id for r in held.collect())


def exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]


def test_code_change_deals_items_by_document_only(spark, tmp_path):
    """Rows of one line number take the greatest new reason; rows without number or document and closed documents stay."""
    put = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}") or spark.read.parquet(f"{tmp_path}/{name}")
    docs = put("docs", [("a", 10, D(1), None), ("b", 10, D(0), 12), ("c", 10, D(0), 10), ("e", 10, D(3), None), (None, 10, D(3), None)],
               "access_key string, doc_type int, value_added decimal(17,2), reason int")
    items = put("items", [
        ("a", 10, 1, "x", D(4), None), ("a", 10, 2, "x", D(2), 5), ("a", 10, 2, "y", D(2), None), ("a", 10, None, "y", D(1), 7), ("b", 10, 1, "x", D(6), 1),
        ("c", 10, 1, "x", D(6), 3), ("d", 10, 1, "x", D(6), 4), (None, 10, 1, "y", D(6), 2),
    ], "access_key string, doc_type int, item_no int, op_code string, value_added decimal(17,2), reason int")
    codes = spark.createDataFrame([("x",)], "code string")
    new_docs, new_items = corrections.op_codes_changed(docs, items, codes)
    assert not [x for x in exchanges(new_items) if "item_no" in x]
    assert {(r["access_key"], r["value_added"], r["reason"]) for r in new_docs.collect()} == {
        ("a", D(6), None), ("b", D(6), None), ("c", D(0), 10), ("e", D(3), None), (None, D(3), None)}
    assert sorted(((r["access_key"], r["item_no"], r["op_code"], r["reason"]) for r in new_items.collect()), key=str) == sorted([
        ("a", 1, "x", None), ("a", 2, "x", 5), ("a", 2, "y", 5), ("a", None, "y", 7), ("b", 1, "x", None), ("c", 1, "x", 3), ("d", 1, "x", 4), (None, 1, "y", 2)], key=str)
    some = spark.createDataFrame([("b", 10)], "access_key string, doc_type int")
    new_docs, new_items = corrections.op_codes_changed(docs, items, codes, some)
    assert {r["access_key"]: r["reason"] for r in new_docs.collect()} == {"a": None, "b": None, "c": 10, "e": None, None: None}
    assert sorted((r["reason"] or 0) for r in new_items.collect()) == [0, 0, 0, 2, 3, 4, 5, 7]


def test_documents_deal_lines_by_order_once(spark, tmp_path):
    put = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    put("dated", [(1, 7, "F", "1996-01-01"), (2, 8, "P", "1999-01-01")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, day string")
    dated = spark.read.parquet(f"{tmp_path}/dated.parquet")
    dated.withColumn("o_orderdate", F.col("day").cast("timestamp_ntz")).drop("day").write.parquet(f"{tmp_path}/orders.parquet")
    put("customer", [(7, 3, 1.0, "AUTO")], "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("supplier", [(5, 4, 1.0), (6, 4, 1.0)], "s_suppkey bigint, s_nationkey int, s_acctbal double")
    put("part", [(9, "ECONOMY", "b"), (10, "LARGE", "b")], "p_partkey bigint, p_type string, p_brand string")
    put("lines", [(1, 9, 5, 1, 10.0, 0.1), (1, 9, 5, 2, 10.0, 0.0), (1, 10, 5, 3, 7.0, 0.0), (1, 10, 6, 4, 7.0, 0.0), (2, 9, 5, 1, 1.0, 0.0), (1, 9, 99, 1, 1.0, 0.0)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double")
    spark.read.parquet(f"{tmp_path}/lines.parquet").selectExpr(
        "*", "1.0D AS l_quantity", "0.0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP_NTZ '1996-02-01' AS l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = R.documents(spark, str(tmp_path))
    assert not [x for x in exchanges(out) if "supplier_key" in x and "order_key" in x]
    assert {(r["order_key"], r["supplier_key"], r["value_added"], r["reason"], r["entry_id"]) for r in out.collect()} == {(1, 5, D(19), None, 7), (1, 6, D(0), 12, 7)}
    docs, items = L.stored(spark, str(tmp_path), "period")
    assert sorted(docs.columns) == ["access_key", "doc_type", "period", "reason", "value_added"]
    assert {(r["access_key"], r["item_no"], r["reason"]) for r in items.collect()} == {("1-5", 1, None), ("1-5", 2, None), ("1-5", 3, 1), ("1-6", 4, 1)}
