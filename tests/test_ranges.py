"""A source read in ranges: which rows each range holds, and what a query's conditions leave of them."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from apportia.sources import ranges

D = dt.date.fromisoformat


def holds(condition, value):
    _, sign, bound = condition
    if sign == "null" or value is None:
        return sign == "null" and value is None
    return {"=": value == bound, "<": value < bound, "<=": value <= bound, ">": value > bound, ">=": value >= bound}[sign]


@pytest.mark.parametrize("seed", range(40))
def test_every_value_is_in_one_range(seed):
    pick = random.Random(seed)
    low = pick.randint(-50, 50)
    high, n = low + pick.choice([0, 1, 5, 40]), pick.randint(1, 12)
    asked = [(pick.choice(["<", "<=", ">", ">=", "="]), pick.randint(-80, 120)) for _ in range(pick.randint(0, 3))]
    found = ranges.spans("x", low, high, n, asked)
    assert len(found) <= n
    for value in [None, *range(-120, 160)]:
        times = sum(any(all(holds(c, value) for c in part) for part in s.either) for s in found)
        wanted = all(holds(("x", *a), value) for a in asked)
        assert times == 1 if wanted else times <= 1


def test_ranges_of_days():
    found = ranges.spans("d", D("1992-01-01"), D("1999-01-01"), 4, [(">=", D("1997-01-01")), ("<", D("1997-02-01"))])
    assert [s.either[0][0][2] for s in found] == [D("1997-01-01"), D("1997-01-08"), D("1997-01-16"), D("1997-01-24")]
    assert found[-1].either == ((("d", ">=", D("1997-01-24")), ("d", "<=", D("1997-02-01"))),)


def test_statement_binds_values():
    sql, values = ranges.statement("t", ["a", 'b"c'], ((("a", ">=", 1), ("a", "<", 5)), (("a", "null", None),)), [("a", "in", (2, 3))], "qmark")
    assert sql == 'SELECT "a", "b""c" FROM t WHERE "a" IN (?, ?) AND (("a" >= ? AND "a" < ?) OR ("a" IS NULL))' and values == [2, 3, 1, 5]
    assert ranges.statement("t", ["a"], ((),), [], "format") == ('SELECT "a" FROM t', [])


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ranges") / "rows")
    df = spark.range(5000).select(
        F.when(F.col("id") % 97 != 0, F.col("id") - 500).alias("key"), F.expr("date_add(DATE'2020-01-01', cast(id % 400 as int))").alias("day"),
        F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("at"), F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("id") / 3).alias("amount"),
        F.concat(F.lit("n"), F.col("id") % 7).alias("name"),
    )
    df.write.parquet(path)
    return path, spark.read.parquet(path)


BOUNDS = {"key": (0, 4000), "day": ("2020-01-10", "2020-12-01"), "at": ("1970-01-01 00:00:00", "1970-06-01 00:00:00")}


@pytest.mark.parametrize("column, condition", [
    ("key", "true"), ("day", "true"), ("at", "true"), ("key", "key < -400"), ("key", "key > 4400"), ("key", "key in (5, 4000, -3)"), ("key", "key > 10 and key < 5"),
    ("key", "key is null"), ("key", "key <=> null"), ("day", "day >= DATE'2020-03-01' and day < DATE'2020-04-01'"), ("at", "at < TIMESTAMP_NTZ'1970-02-01 00:00:00'"),
    ("day", "amount > 1600"), ("key", "amount = 'NaN' and name > 'n3'"), ("day", "name = 'n3' and key > 0"), ("at", "key % 3 = 1 or day = DATE'2020-01-05'"), ("key", "not key = 4"),
])
def test_rows_equal_those_of_the_files(spark, files, column, condition):
    path, plain = files
    got = ranges.read_ranges(spark, column, *BOUNDS[column], 3, path=path).where(condition)
    assert got.schema == plain.schema
    text = lambda df: sorted(map(str, df.collect()))
    assert text(got) == text(plain.where(condition))


def test_a_window_is_cut_into_tasks_and_nothing_else_is_read(spark, files):
    path, _ = files
    window = ranges.read_ranges(spark, "key", 0, 4000, 6, path=path).where("key >= 1000 and key < 1600")
    assert window.rdd.getNumPartitions() == 6
    per_task = [r.n for r in window.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 6 and max(per_task) <= 100
    assert ranges.read_ranges(spark, "key", 0, 4000, 6, path=path).where("key > 9 and key < 3").rdd.getNumPartitions() == 1


def test_some_columns_of_files(spark, files):
    got = ranges.read_ranges(spark, "key", 0, 4000, 3, schema="key bigint, name string", path=files[0])
    assert got.columns == ["key", "name"] and got.count() == 5000


@pytest.mark.parametrize("relation", [{"table": "docs"}, {"query": "select * from docs;"}])
def test_a_database_gets_the_window(spark, tmp_path, relation):
    rows = [{"id": i, "day": str(D("2024-01-01") + dt.timedelta(i)) if i % 11 else None, "name": f"n{i % 3}"} for i in range(200)]
    (tmp_path / "rows.json").write_text(json.dumps(rows))
    os.mkdir(tmp_path / "log")
    read = lambda: ranges.read_ranges(
        spark, "day", "2024-01-01", "2024-07-01", 4, schema="id bigint, day date, name string", driver="tests.fake_driver", connect=str(tmp_path), **relation
    )
    assert sorted(r.id for r in read().collect()) == list(range(200))
    assert len(os.listdir(tmp_path / "log")) == 4
    got = read().where("day >= DATE'2024-02-01' and day < DATE'2024-03-01' and name = 'n1'").collect()
    assert sorted(r.id for r in got) == [i for i in range(31, 60) if i % 11 and i % 3 == 1]
    asked = [json.loads(p.read_text()) for p in (tmp_path / "log").iterdir()][0:]
    narrow = [a for a in asked if "2024-02-01" in a[1]]
    assert len(narrow) == 4 and all("n1" in a[1] and '"name" =' in a[0] for a in narrow)
    assert all(("(select * from docs) src" if "query" in relation else "FROM docs") in a[0] for a in asked)


@pytest.mark.parametrize("options", [{"low": 5, "high": 1}, {"low": 1, "high": 5, "parts": 0}])
def test_bad_ranges_are_refused(spark, files, options):
    with pytest.raises(Exception, match="parts must be"):
        ranges.read_ranges(spark, "key", path=files[0], **options).collect()
    with pytest.raises(Exception, match="ranges need whole numbers"):
        ranges.read_ranges(spark, "name", "a", "b", path=files[0]).collect()
