"""Apportionment and top-k search against plain versions."""

import random

import pytest

from apportia.llm import mixing, topk

DOCS = "doc_id long, text string, source string, size string, taken string"


def plain_targets(sizes, weights=(5, 2, 1)):
    """Fill by weight, stop what is full, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full, left = {s: 0.0 for s in order}, set(), 1.5 * sum(sizes.values())
    while left > 1e-9 and len(full) < len(order):
        open_ = [s for s in order if s not in full]
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += share * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
    return target


def plain_seats(votes, seats):
    won = {k: 0 for k in votes}
    for _ in range(seats):
        best = max((k for k in votes if votes[k] > 0), key=lambda k: (votes[k] / (2 * won[k] + 1), [-ord(c) for c in k]), default=None)
        if best is not None:
            won[best] += 1
    return won


def test_apportion_is_highest_quotients(spark):
    pick = random.Random(3)
    rows, want = [], {}
    for g in range(6):
        votes = {f"k{i:02d}": float(pick.choice([0, 1, 7, 50, 900])) for i in range(12)}
        seats = pick.choice([0, 1, 5, 40, 333])
        rows += [(g, k, v, seats) for k, v in votes.items()]
        want |= {(g, k): n for k, n in plain_seats(votes, seats if any(votes.values()) else 0).items()}
    df = spark.createDataFrame(rows, "g int, k string, v double, s long")
    got = {(r.g, r.k): r.quota for r in mixing.apportion(df, ["g"], "k", "v", "s").collect()}
    assert got == want


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 5000, "c": 40, None: 7}, {"a": 0, "b": 3}, {"z": 10, "é": 2000, "~": 30, "y": 0},
])
def test_targets_fill_and_share_again(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_comes_near_its_targets(spark):
    pick = random.Random(1)
    rows = []
    for i in range(600):
        source = pick.choice(["hot"] * 10 + ["a", "b", "c", None])
        rows.append((i, " \t\n".join("w" * pick.randint(1, 4) for _ in range(pick.randint(0, 90))), source, "x", "y"))
    rows += [(1000, None, "a", "x", "y"), (1001, "", "a", "x", "y"), (7, "one two", "b", "x", "y"), (7, "one two", "b", "x", "y")]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))
    sums = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sums.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in sums.items():
        assert abs(sum(taken) - target) <= max(40, 0.02 * target), (size, target, sum(taken))
    assert sum(t for _, t in sums) == pytest.approx(1.5 * sum(r.size for r in got), rel=0.01)


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    got = mixing.mix(spark.createDataFrame([(1, None, "a", "", ""), (2, " \t", None, "", "")], DOCS)).collect()
    assert [(r.size, r.taken) for r in got] == [(0, 0), (0, 0)]


def test_top_k_against_all_pairs(spark):
    pick = random.Random(2)
    rows = [(i, [pick.choice([-1.5, 0.25, 0.1, 2.0]) for _ in range(3)], "x") for i in range(120)]
    rows += [(200, None, "x"), (300, [1.0, None, 2.0], "x"), (400, [float("nan"), 1.0, 1.0], "x"), (500, [float("inf"), 1.0, 1.0], "x")]
    rows += [(1, rows[1][1], "x"), (600, [], "x"), (None, [1.0, 1.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, rank string")
    vectors = df.select("id", topk.whole_numbers("embedding", 1024).alias("vector"))
    import math

    held = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = {}
    for r in topk.top_k(vectors.where("id % 10 = 0"), vectors, k=7, query_rows=5, shard_rows=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = {}
    for q, v in dict(held).items():
        if q % 10 == 0:
            s = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in held if i != q))[:7]
            want[q] = [(n + 1, i, -x) for n, (x, i) in enumerate(s)]
    assert {q: sorted(v) for q, v in got.items()} == want


def test_top_k_of_large_numbers_and_of_nothing(spark):
    big = 3_000_000_000
    df = spark.createDataFrame([(0, [big, 1]), (1, [1, 1]), (2, [2, -1])], "id long, vector array<long>")
    got = {(r["rank"], r.vec_id, r.score) for r in topk.top_k(df.where("id = 0"), df).collect()}
    assert got == {(1, 2, 2 * big - 1), (2, 1, big + 1)}
    none = spark.createDataFrame([], "id long, vector array<long>")
    assert topk.top_k(none, none).collect() == []
    assert topk.top_k(df.where("id = 0"), df.where("id = 0")).collect() == []
