"""Writes, loads, imports, incremental runs and sources."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from apportia import schemas, session
from apportia.operators import sinks
from apportia.plans import dispatch, imports, ledger, results
from apportia.retail import frames as R
from apportia.retail.load_queries import goods_catalog, ledger_parts, loose_catalog, telecom_catalog, ticket_parts, two_phase_registry
from apportia.sources import tables
from apportia.streaming import incremental

KV = "k int, p int, v string"


def test_upsert_null_key_and_repeat(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (None, 1, "b"), (2, 1, "c")], KV)
    source = spark.createDataFrame([(None, 1, "B"), (2, 1, "C"), (3, 1, "D")], KV)
    once = sinks.upsert(target, source, ["k", "p"])
    want = [(None, 1, "B"), (1, 1, "a"), (2, 1, "C"), (3, 1, "D")]
    assert rows(once) == want and rows(sinks.upsert(once, source, ["k", "p"])) == want


def test_replace_partitions_and_merge(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], KV)
    assert sinks.replace_partitions(first, path, ["p"]).get["rows"] == 3
    again = spark.createDataFrame([(9, 1, "z")], KV)
    sinks.replace_partitions(again, path, ["p"])
    assert rows(spark.read.parquet(path), "k", "p", "v") == [(3, 2, "c"), (9, 1, "z")]
    change = spark.createDataFrame([(9, 1, "y"), (10, 1, "x")], KV)
    for _ in range(2):
        sinks.merge_partitions(spark, path, change, ["k", "p"], ["p"])
        assert rows(spark.read.parquet(path), "k", "p", "v") == [(10, 1, "x"), (3, 2, "c"), (9, 1, "y")]
    with pytest.raises(ValueError):
        sinks.merge_partitions(spark, path, change, ["k"], ["p"])


def test_surrogate_ids_are_dense_and_stable(spark):
    keys = spark.range(5000).select(F.sha1(F.col("id").cast("string")).alias("key"))
    first = sinks.assign_ids(keys.limit(5000).where("key < '8'"), None, "key")
    n = first.count()
    both = sinks.assign_ids(keys, first, "key").collect()
    assert sorted(r["id"] for r in both) == list(range(1, 5001))
    old = {r["key"]: r["id"] for r in first.collect()}
    assert len(old) == n and all(r["id"] == old[r["key"]] for r in both if r["key"] in old)


def test_close_versions(spark, rows):
    T = datetime
    ddl = "reg int, start timestamp, stop timestamp, v string"
    stored = spark.createDataFrame([(1, T(2024, 1, 1), None, "a")], ddl)
    new = spark.createDataFrame([(1, T(2024, 2, 1), None, "b"), (1, T(2024, 1, 1), None, "ignored")], ddl)
    got = rows(sinks.close_versions(stored, new, ["reg"], "start", "stop"))
    assert got == [(1, T(2024, 1, 1), T(2024, 1, 31, 23, 59, 59), "a"), (1, T(2024, 2, 1), None, "b")]


def test_run_events(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert sinks.audited(spark, path, 1, "load", lambda: {"documents": 3, "items": 4}) == {"documents": 3, "items": 4}
    with pytest.raises(ZeroDivisionError):
        sinks.audited(spark, path, 2, "load", lambda: 1 / 0)
    got = {r["run_id"]: (r["status"], r["amount"]) for r in sinks.run_states(spark.read.parquet(path)).collect()}
    assert got == {1: ("succeeded", 7), 2: ("failed", 0)}


def test_verify_written(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write(spark.range(3).select(F.lit(1).alias("run_id")), path)
    sinks.verify_written(spark, path, 1, 3)
    with pytest.raises(RuntimeError):
        sinks.verify_written(spark, path, 1, 4)


def test_export_and_read_delimited(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.export_csv(spark.createDataFrame([("São", "1,5")], "a string, b string"), path)
    back = tables.read_delimited(spark, path, encoding="UTF-8")
    assert back.columns == ["a", "b"] and back.first()["a"] == "São"
    tables.sample_to_csv(spark.range(10).toDF("x"), str(tmp_path / "s"), 4)
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 4


def test_sources(spark):
    df = spark.createDataFrame([("k", 5)], "CHAVENFE string, VNF int")
    out = tables.resolve(df, schemas.SECTIONS["goods_total"])
    assert out.schema == schemas.SECTIONS["goods_total"].schema and out.first()["total"] == D(5)
    assert tables.usable(df, "nope > 1", optional=True) is None and tables.usable(df, "VNF > 1") is not None
    for wrong in ("nope > 1", "VNF >", "VNF > (1"):
        with pytest.raises(AnalysisException):
            tables.usable(df, wrong, optional=wrong != "nope > 1")
    assert tables.read_section(spark, {}, "ticket_trip").count() == 0
    for main in schemas.MAIN_SECTIONS:
        with pytest.raises(KeyError):
            tables.read_section(spark, {}, main)
    assert tables.read_reference(spark, {}, "products").columns == ["code", "participates"]
    with pytest.raises(KeyError):
        tables.read_references(spark, {})
    opts = tables.jdbc_options("jdbc:x", table="t", where="a > 1", partition=("id", 0, 100, 8))
    assert opts["dbtable"] == "(select * from t where a > 1) src" and opts["numPartitions"] == "8"
    assert tables.jdbc_options("jdbc:x", query="select 1;")["query"] == "select 1"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("one")
    assert "one" in [r["tableName"] for r in tables.tables(spark).collect()]
    assert tables.columns_of(spark.table("one")) == [("a", "int")]
    assert tables.read_table(spark, {"x": "one"}, "x", "a = 1", ["A", "b"]).columns == ["a"]
    assert tables.days(spark, "2024-01-30", "2024-02-02").count() == 4


def test_checkpoint_cuts_lineage(spark):
    df = session.cut_lineage(spark.range(5).where("id > 1"))
    assert df.count() == 3 and "Filter" not in df._jdf.queryExecution().optimizedPlan().toString()


MUNIS = "muni int, parent int, state string, name string"
VA = list(imports.VALUE_ADDED_COLUMNS)
CLEAN = ("2024", "202401", "11", "S", "R$ 1.234,50", "11", "")


@pytest.fixture
def munis(spark):
    return spark.createDataFrame([(10, None, "GO", ""), (11, 10, "GO", ""), (30, None, "SP", "")], MUNIS)


def va_import(spark, munis, *rows_):
    raw = spark.createDataFrame(list(rows_), ", ".join(f"`{c}` string" for c in VA))
    return imports.import_value_added(raw, munis, 2024, (202401, 202412), 11, 7)


def test_clean_import(spark, munis):
    row = va_import(spark, munis, CLEAN).first()
    assert (row["muni"], row["reg"], row["value_added"], row["run_id"]) == (10, 0, D("1234.50"), 7)


@pytest.mark.parametrize(
    "place, value, check",
    [
        (0, "2023", "other_year"), (1, "202301", "other_period"), (2, "9", "other_type"), (3, "X", "bad_direction"), (4, "", "no_value"),
        (4, "abc", "bad_value"), (5, None, "no_muni"), (5, "30", "outside_state"), (5, "77", "outside_state"), (6, "x", "bad_reg"),
    ],
)
def test_rejected_import(spark, munis, place, value, check):
    bad = tuple(value if i == place else v for i, v in enumerate(CLEAN))
    with pytest.raises(imports.ImportRejected) as e:
        va_import(spark, munis, CLEAN, bad)
    assert e.value.failures[check] == 1


def test_import_of_an_unknown_type_or_column(spark, munis):
    raw = spark.createDataFrame([("2024",)], "ano string")
    with pytest.raises(imports.ImportRejected):
        imports.import_value_added(raw, munis, 2024, (202401, 202412), 99, 7)
    with pytest.raises(imports.ImportRejected, match="referencia"):
        imports.import_value_added(raw, munis, 2024, (202401, 202412), 11, 7)


def test_index_import(spark, munis):
    make = lambda *r: spark.createDataFrame(list(r), "ano string, etapa_indice string, tipo_indice string, indice_participacao string, codigo_municipio string")
    row = imports.import_index(make(("2024", "P", "V", "0,1234567890123456", "11")), munis, "P", "V", 1).first()
    assert (row["muni"], row["share"]) == (10, D("0.1234567890123456"))
    with pytest.raises(imports.ImportRejected) as e:
        imports.import_index(make(("2024", "P", "V", "1", "10"), ("2024", "P", "V", "2", "10")), munis, "P", "V", 1)
    assert e.value.failures == {"repeated_muni": 2}
    with pytest.raises(imports.ImportRejected):
        imports.import_index(make(("2024", "P", "V", "1", "10")), munis, "X", "V", 1)


SF = "/root/testdata/sf0.001"


def test_load_a_window_twice(spark, rows, tmp_path):
    """A whole window is one job, and loading it again changes nothing."""
    docs, items = str(tmp_path / "docs"), str(tmp_path / "items")
    catalog = goods_catalog(spark, SF)
    registry = two_phase_registry(spark, SF)
    window = ("1996-01-01 00:00:00", "1996-12-31 23:59:59")
    load = lambda: dispatch.load(spark, "goods", catalog, window, 1, docs, items, registry, R.HOME)
    counts = load()
    first = rows(spark.read.parquet(docs), "access_key", "value_added", "appropriation")
    assert counts["documents"] == len(first) > 0 and counts["items"] == spark.read.parquet(items).count()
    assert load() == counts and rows(spark.read.parquet(docs), "access_key", "value_added", "appropriation") == first


def test_part_month_loads_replace_their_window_only(spark, rows, tmp_path):
    """Days 1-10 and days 11-31 leave what the month left; 12-hour slices do too; an empty reload empties its window."""
    docs, items = str(tmp_path / "docs"), str(tmp_path / "items")
    catalog, registry = goods_catalog(spark, SF), two_phase_registry(spark, SF)
    load = lambda first, last, c=catalog: dispatch.load(spark, "goods", c, (first, last), 1, docs, items, registry, R.HOME)
    held = lambda: (rows(spark.read.parquet(docs), "access_key", "value_added"), rows(spark.read.parquet(items), "access_key", "item_no"))
    load("1996-02-01 00:00:00", "1996-03-31 23:59:59")
    month = held()
    assert month[0] and month[1]
    load("1996-03-01 00:00:00", "1996-03-10 23:59:59")
    load("1996-03-11 00:00:00", "1996-03-31 23:59:59")
    assert held() == month
    mark = [datetime(1996, 3, 29, 23, 59, 59)]
    assert incremental.advance(lambda: mark[0], lambda m: mark.__setitem__(0, m), timedelta(hours=12), datetime(1996, 3, 31, 23, 59, 59), load) == 4
    assert held() == month
    none = catalog | {"goods_header": tables.open_table(spark, catalog, "goods_header").limit(0)}
    assert load("1996-03-01 00:00:00", "1996-03-31 23:59:59", none) == {"documents": 0, "items": 0}
    left = spark.read.parquet(docs)
    assert left.count() > 0 and left.where("emitted_at >= '1996-03-01'").count() == 0
    assert spark.read.parquet(items).join(left, "access_key", "left_anti").count() == 0


@pytest.mark.parametrize("kind", ["consumer", "transport", "energy", "ticket", "ledger", "received", "loose", "telecom"])
def test_dispatch_kinds(spark, kind):
    catalog = goods_catalog(spark, SF)
    catalog |= ticket_parts(spark, SF)
    catalog |= dict(zip(("ledger_document", "ledger_item", "ledger_period"), ledger_parts(spark, SF)))
    catalog |= {n: spark.createDataFrame([], schemas.SECTIONS[n].schema) for n in ("transport_doc", "energy_doc")}
    catalog |= loose_catalog(spark, SF) | telecom_catalog(spark, SF)
    registry = two_phase_registry(spark, SF)
    docs, items = dispatch.prepare(spark, kind, catalog, ("1995-01-01 00:00:00", "2002-01-01 00:00:00"), 1, registry, home=R.HOME)
    assert docs.schema.names == schemas.DOCUMENT.names
    assert docs.count() >= (0 if kind in ("transport", "energy") else 1)
    if items is not None:
        assert items.schema.names == schemas.ITEM.names
    with pytest.raises(ValueError):
        dispatch.prepare(spark, "other", catalog, ("a", "b"), 1)


def test_energy_totals_come_from_up_to_three_tables(spark):
    head = {"access_key": "k", "emitted": datetime(2024, 1, 5), "model": "66", "environment": "1", "issuer_state": "GO", "issuer_reg": "7"}
    schema = schemas.SECTIONS["energy_doc"].schema
    docs = spark.createDataFrame([tuple((head | {"access_key": k}).get(f.name) for f in schema.fields) for k in "abcd"], schema)
    total = lambda *rows: spark.createDataFrame([(k, D(v), D(v)) for k, v in rows], "access_key string, total decimal(17,2), gross decimal(17,2)")
    catalog = {"energy_doc": docs, "energy_total": total(("a", 1)), "energy_total_2": total(("a", 2), ("b", 2)), "energy_total_3": total(("b", 3), ("c", 3))}
    out, _ = dispatch.prepare(spark, "energy", catalog, ("2024-01-01 00:00:00", "2024-01-31 23:59:59"), 1, home="GO")
    got = {r.access_key: r.total for r in out.collect()}
    assert (got["a"], got["b"], got["c"]) == (1, 2, 3) and not got["d"]


def test_stored_results(spark, tmp_path):
    """Value added and index replace their own slice."""
    va, index = str(tmp_path / "va"), str(tmp_path / "index")
    docs, reg, munis_ = R.documents(spark, SF), R.registry(spark, SF), R.munis(spark, SF)
    window = ("1997-01-01", "1997-12-31")
    n = results.store_value_added(docs, reg, munis_, va, 1, window, R.HOME)
    assert n == results.store_value_added(docs, reg, munis_, va, 2, window, R.HOME) == spark.read.parquet(va).count() > 0
    for part in (("1997-01-02", "1997-01-31"), ("1997-01-01", "1997-01-30"), ("1997-02-01", "1997-01-31")):
        with pytest.raises(ValueError):
            results.store_value_added(docs, reg, munis_, va, 2, part, R.HOME)
    before = spark.read.parquet(va)
    rest = before.where("period <> 199703").count()
    assert results.store_value_added(docs.limit(0), reg, munis_, va, 3, ("1997-03-01", "1997-03-31"), R.HOME) == 0
    assert spark.read.parquet(va).count() == rest < n
    results.store_value_added(docs, reg, munis_, va, 1, ("1997-03-01", "1997-03-31"), R.HOME)
    m = results.store_index(spark, va, munis_, index, 3, 1997, home=R.HOME)
    out = spark.read.parquet(index)
    assert m == out.count() and out.schema["share"].dataType.simpleString() == "decimal(22,18)"
    assert D(99) < out.agg(F.sum("share")).first()[0] <= D(100)


def test_ledger_split_by_code_only(spark):
    items = spark.createDataFrame([("a", D(1), True), ("a", D(2), False)], "access_key string, value_added decimal(17,2), code_participates boolean")
    row = ledger.settle(items).first()
    assert (row["value_in"], row["value_out"], row["reason"]) == (D(1), D(2), None)


def test_marks_advance_after_a_stored_window():
    state = {"mark": datetime(2024, 1, 1)}
    seen = []

    def load(first, last):
        if len(seen) == 2:
            raise RuntimeError
        seen.append((first, last))

    go = lambda: incremental.advance(
        lambda: state["mark"], lambda m: state.update(mark=m), timedelta(hours=12), datetime(2024, 1, 3), load
    )
    with pytest.raises(RuntimeError):
        go()
    assert state["mark"] == datetime(2024, 1, 2) and seen[1] == ("2024-01-01 12:00:01", "2024-01-02 00:00:00")


def test_arrivals(spark, rows, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    put = lambda *r: spark.createDataFrame(list(r), KV).write.mode("append").parquet(source)
    schema = spark.createDataFrame([], KV).schema
    run = lambda: incremental.load_arrivals(spark, source, schema, target, ["k", "p"], ["p"], marks)
    put((1, 1, "a"), (2, 2, "b"))
    run()
    run()
    put((1, 1, "c"), (3, 1, "d"))
    run()
    assert rows(spark.read.parquet(target), "k", "p", "v") == [(1, 1, "c"), (2, 2, "b"), (3, 1, "d")]
