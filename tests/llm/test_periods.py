"""Periodic runs against a plain search over all periods, with tiles of several sizes, and odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from apportia.llm import periods, queries


def brute(words):
    """(start, period, length) of each run, by comparing all words a period apart."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, p, n) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {i for s, p, n in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(seed, n):
    pick = random.Random(seed)
    kind = seed % 6
    if kind == 0:
        return [pick.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["x"] * n
    if kind == 2:
        words = [str(pick.randrange(5)) for _ in range(max(1, n // pick.randrange(4, 12)))]
        return (words * (n // len(words) + 1))[:n]
    words = [str(pick.randrange(40)) for _ in range(n)]
    for _ in range(kind):
        at, p, times = pick.randrange(n), pick.randrange(1, max(2, n // 6)), pick.randrange(3, 9)
        words[at : at + p * times] = (words[at : at + p] * times)[: len(words[at : at + p * times])]
    return words


@pytest.mark.parametrize("core", [1, 7, 16, 33, 64, 8192])
def test_tiles_brute(core):
    """Fragments of all tiles, stitched in plain Python, give each run of the brute search and no other."""
    for seed in range(150):
        words = made(seed, random.Random(seed).randrange(1, 260))
        n, ids = len(words), periods.numbered([w.encode() for w in words])
        cut = periods.tiles(n, core) if n > core else [(0, periods.octaves(n), 0, n, 0, n)]
        parts = {x for low, high, at, stop, a, b in cut for x in periods.solved(periods.numbered([w.encode() for w in words[a:b]]), low, high, at, stop, a, n)}
        spans = {}
        for p in {x[0] for x in parts}:
            done = []
            for _, first, last in sorted(x for x in parts if x[0] == p):
                if done and first <= done[-1][1]:
                    done[-1][1] = max(done[-1][1], last)
                else:
                    done.append([first, last])
            for first, last in done:
                assert all(ids[i] == ids[i + p] for i in range(first, last))
                if last - first + p >= max(6, 4 * p):
                    spans[first, last - first + p] = min(p, spans.get((first, last - first + p), p))
        assert sorted((s, p, length) for (s, length), p in spans.items()) == brute(words), (seed, core)


@pytest.mark.parametrize("core", [20, 8192])
def test_periodic_brute(spark, core):
    rows = [(i, " \n".join(made(i, random.Random(i).randrange(1, 300))), None, None, i) for i in range(60)]
    rows += [(1, "a b a b a b a b", None, None, 0), (None, "z z z z z z", None, None, 0), (None, "z\x0bz z z z", None, None, 0)]
    rows += [(2, None, None, None, 0), (3, "", None, None, 0), (4, " \t\r\n\x0c ", None, None, 0), (5, "p q r " * 200, 10, 7, 0), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, period int, n long")
    want = []
    for doc, text, start, period, _ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        if period:
            words = [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]
        runs = brute(words)
        kept = collapsed(words, runs)
        want.append((doc, len(words), runs, kept if runs else None, hashlib.sha256(kept.encode()).hexdigest()))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept, r.collapsed_sha256) for r in periods.periodic(docs, core).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periods.periodic(docs.limit(0)).collect() == []


def test_periodic_query(spark, tmp_path):
    """The registered query over texts of some words to some thousands, against the contract in plain Python."""
    rows = [(i, " ".join(made(7 * i + 3, 40 + 9 * i)), "x") for i in range(70)] + [(2**40, "w1 w2 w3 " * 8000 + "w4", "x"), (None, None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc, text, _ in rows:
        words, h = (text or "").split(), zlib.crc32(str(doc).encode())
        n, g = len(words), h // 10
        if doc is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words) if n < 9000 else [(0, 3, n - 1)]
        best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
        digests = ["".join(f"{s},{length},{p}\n" for s, p, length in runs), collapsed(words, runs)]
        want.append((doc, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else [None] * 4),
                     *[hashlib.sha256(x.encode()).hexdigest() for x in digests]))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert dict(got.dtypes) == {c: "string" if "sha" in c else "bigint" for c in got.columns}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.where(F.col("n_runs") > 0).count() > 20
