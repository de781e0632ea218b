"""Mergeable counts, rejected lines, and the timeline's reads."""

import random

from pyspark.sql import functions as F

from apportia import schemas
from apportia.operators import history, rollups
from apportia.sources import tables


def test_sketches_merge_like_sets(spark):
    """Windows of days merged from sketches, against the sets; a day that is loaded again replaces its sketch."""
    pick = random.Random(8)
    data = [(d, t, pick.randrange(4000)) for d in range(12) for t in "ab" for _ in range(800)] + [(0, "a", None)]
    df = spark.createDataFrame(data, "day int, kind string, k bigint")
    kept = rollups.count_sketches(df, ["day", "kind"], "k").cache()
    assert kept.count() == 24
    for low, high in ((0, 0), (3, 8), (0, 11)):
        got = {r.kind: (r.documents, r.rows) for r in rollups.sketched_count(kept.where(F.col("day").between(low, high)), ["kind"]).collect()}
        for kind in "ab":
            mine = [k for d, t, k in data if t == kind and low <= d <= high]
            exact = len({k for k in mine if k is not None})
            assert abs(got[kind][0] - exact) <= 5 * 1.04 / 2**7 * exact and got[kind][1] == len(mine)
    again = rollups.count_sketches(df.where("day = 3 AND k < 10"), ["day", "kind"], "k")
    merged = rollups.sketched_count(kept.where("day <> 3").unionByName(again).where("day = 3"), ["day"]).first()
    assert merged.documents == len({k for d, _, k in data if d == 3 and k is not None and k < 10})
    assert rollups.sketched_count(kept.limit(0), ["kind"]).collect() == []


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("id|amount|name\n1|2.50|Jos\xe9\n2|x|bad amount\n3|1.00\n\n4|1.00|n|more\n5||\n".encode("latin-1"))
    (tmp_path / "b.txt").write_bytes(b"id|amount|name\n6|1.25|b\nseven|1|b\n")
    schema = schemas.struct("id bigint, amount decimal(9,2), name string")
    rows, rejects = tables.read_checked(spark, str(tmp_path), schema)
    got = sorted((r.id, str(r.amount), r.name) for r in rows.collect())
    assert got == [(1, "2.50", "Jos\xe9"), (5, "None", None), (6, "1.25", "b")]
    assert sorted((r.file, r.line) for r in rejects.collect()) == [
        ("a.txt", "2|x|bad amount"), ("a.txt", "3|1.00"), ("a.txt", "4|1.00|n|more"), ("b.txt", "seven|1|b"),
    ]
    assert rejects.count() == 4 and rows.select("name").count() == 3


def test_timeline_reads_each_source_once(spark):
    reads = []
    made = lambda name, rows: spark.createDataFrame(rows, f"reg int, at int, {name} int")
    sources = [made("a", [(1, 1, 5), (1, 4, 6)]), made("b", [(1, 2, 7), (2, 1, 8)])]

    def store(df):
        reads.append(df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD"))
        return df.cache()

    line = history.merge_timelines(
        [s.withColumn("at", F.timestamp_seconds("at")) for s in sources], "reg", "at", {"a": None, "b": 0}, store
    )
    got = sorted((r.reg, r["at"].second, r.a, r.b) for r in line.collect())
    assert got == [(1, 1, 5, 0), (1, 2, 5, 7), (1, 4, 6, 7), (2, 1, None, 8)] and reads == [2]
