"""Loads as one commit: kills between writes, two runners, and what is left of old runs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from apportia.operators import commits
from apportia.plans import dispatch
from apportia.plans.store import PARTITIONS
from apportia.retail import frames as R
from apportia.retail.load_queries import goods_catalog, two_phase_registry
from apportia.sources import tables
from apportia.streaming import incremental

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    return commits.Tables(spark, f"file://{tmp_path}/tables", ["p"])


def rows_in(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, p int, v string")


def held(store, table="a", state=None):
    found = store.read(table, state)
    return sorted(map(tuple, found.select("k", "p", "v").collect())) if found is not None else []


def test_commit_and_read(spark, store):
    assert store.state() == commits.State() and held(store) == []
    first = store.commit(store.state(), {"a": commits.Change(rows_in(spark, (1, 1, "x"), (2, 2, "y")))}, {"m": "1"})
    new = rows_in(spark, (3, 2, "z"))
    change = commits.replaced_rows(store, first, "a", new, lambda v: v == [2], F.col("k") == 2)
    second = store.commit(first, {"a": change, "b": commits.Change(rows_in(spark, (9, 9, "b")))})
    assert held(store) == [(1, 1, "x"), (3, 2, "z")] and held(store, "b") == [(9, 9, "b")]
    assert held(store, "a", first) == [(1, 1, "x"), (2, 2, "y")] and second.marks == {"m": "1"} == store.state().marks
    emptied = commits.replaced_rows(store, second, "a", new.limit(0), lambda v: v == [2], F.col("p") == 2)
    third = store.commit(second, {"a": emptied})
    assert held(store) == [(1, 1, "x")] and list(third.tables["a"]) == ["[1]"]
    with pytest.raises(ValueError):
        store.commit(third, {"a": commits.Change(spark.createDataFrame([(1, None, "x")], "k int, p int, v string"))})
    with pytest.raises(commits.Conflict):
        store.commit(second, {"a": commits.Change(rows_in(spark, (7, 7, "late")))})
    assert store.state() == third and store.vacuum() > 0
    assert held(store) == [(1, 1, "x")] and held(store, "b") == [(9, 9, "b")] and store.vacuum() == 0


def test_a_load_killed_between_its_writes_leaves_the_old_state(spark, tmp_path, monkeypatch):
    """Documents are written, then the run stops before its items: readers see all of the load before, and nothing of this one."""
    store = commits.Tables(spark, f"file://{tmp_path}/docs", PARTITIONS)
    catalog, registry = goods_catalog(spark, SF), two_phase_registry(spark, SF)
    go = lambda first, last, c=catalog: dispatch.load_committed(spark, "goods", c, (first, last), 1, store, registry, R.HOME)
    month = ("1996-02-01 00:00:00", "1996-03-31 23:59:59")
    counts = go(*month)
    see = lambda: (sorted(store.read("documents").select("access_key", "value_added").collect()), sorted(store.read("items").select("access_key", "item_no").collect()))
    before, state = see(), store.state()
    assert counts == {"documents": len(before[0]), "items": len(before[1])} and before[1]

    class Killed(BaseException):
        pass

    written, partitions = [], store.partitions

    def stop_at_second(rows):
        found = partitions(rows)
        if "written" in calls:
            written.append(found)
            if len(written) == 1:
                raise Killed
        return found

    calls = set()
    real = commits.Tables.commit

    def commit(self, base, changes, marks=None):
        calls.add("written")
        return real(self, base, changes, marks)

    monkeypatch.setattr(store, "partitions", stop_at_second)
    monkeypatch.setattr(commits.Tables, "commit", commit)
    none = catalog | {"goods_header": tables.open_table(spark, catalog, "goods_header").where("ide_mod = '55'").limit(3)}
    with pytest.raises(Killed):
        go(*month, none)
    monkeypatch.undo()
    assert written and store.state() == state and see() == before
    assert go("1996-03-01 00:00:00", "1996-03-10 23:59:59") and see() == before
    empty = catalog | {"goods_header": tables.open_table(spark, catalog, "goods_header").limit(0)}
    assert go("1996-03-01 00:00:00", "1996-03-31 23:59:59", empty) == {"documents": 0, "items": 0}
    left = store.read("documents")
    assert left.count() > 0 and left.where("emitted_at >= '1996-03-01'").count() == 0
    assert store.read("items").join(left, "access_key", "left_anti").count() == 0


def test_two_runners_share_a_mark(spark, store):
    """Each window is stored once, whoever comes first; a runner that stops is continued from the stored mark."""
    start, day = datetime(2024, 1, 1), timedelta(days=1)
    log, stops = [], [True]

    def load(name):
        def run(first, last, state, marks):
            if name == "one" and len(log) == 1:
                incremental.advance_stored(store, "docs", start, day, start + 3 * day, load("two"))
            if name == "three" and stops.pop():
                raise RuntimeError("stopped")
            p = int(first[8:10])
            store.commit(state, {"a": commits.Change(rows_in(spark, (p, p, name)))}, marks)
            log.append((name, p))
        return run

    go = lambda name, limit: incremental.advance_stored(store, "docs", start, day, start + limit * day, load(name))
    assert go("one", 4) == 2
    assert log == [("one", 1), ("two", 2), ("two", 3), ("one", 4)]
    with pytest.raises(RuntimeError):
        go("three", 5)
    assert store.state().marks == {"docs": "2024-01-05T00:00:00"} and go("one", 5) == 1
    assert held(store) == [(1, 1, "one"), (2, 2, "two"), (3, 3, "two"), (4, 4, "one"), (5, 5, "one")]
