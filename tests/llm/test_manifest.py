"""Merkle manifest: hashed again in plain Python, with blocks of several sizes, and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from apportia.llm import manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def climbed(digests):
    """(root, path of each leaf): siblings left and right, level by level."""
    at, paths = list(range(len(digests))), [[] for _ in digests]
    while len(digests) > 1:
        runs = [digests[i : i + 3] for i in range(0, len(digests), 3)]
        for k, place in enumerate(at):
            run, i = runs[place // 3], place % 3
            paths[k].append(("".join(run[:i]), "".join(run[i + 1 :])))
            at[k] = place // 3
        digests = [h(*r) for r in runs]
    return digests[0], paths


def brute(rows, now_of):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), leaf_of(r, now_of(r))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, ups = [], []
    for s in order:
        by[s].sort()
        top, paths = climbed([x[2] for x in by[s]])
        tops.append(top)
        ups.append(paths)
    root, above = climbed(tops) if tops else (None, [])
    out = []
    for s, top, paths, up in zip(order, tops, ups, above):
        for (some, doc, leaf, now), path in zip(by[s], paths):
            cur = now
            for left, right in path + up:
                cur = h(left, cur, right)
            out.append((doc if some else None, leaf, top, root, h(*[a + b for a, b in path + up]), cur, cur == root))
    return out


def rows_of(n, seed):
    pick = random.Random(seed)
    sources = [None, "", "a", "b\U00010330", "b￮", *["hot"] * 4]
    rows = [
        (pick.choice([i, i, i, i // 2, None]), pick.choice([None, "", f"é{i}\nline\n", "same\ntext"]), pick.choice([None, "en"]),
         pick.choice(sources), pick.choice([None, -3, i]), "x", 1)
        for i in range(n)
    ]
    return rows + rows[:3]


@pytest.mark.parametrize("n, levels", [(0, 2), (1, 2), (2, 3), (60, 1), (90, 2), (90, 7)])
def test_manifest_brute(spark, n, levels):
    rows = rows_of(n, n + levels) if n else []
    docs = spark.createDataFrame(rows, SCHEMA)
    got = manifest.manifest(manifest.leaves(docs, F.replace("text", F.lit("\n"), F.lit(""))), levels)
    got = got.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof("path").cast("binary"), 256), manifest.folded("now", "path").alias("f"),
        F.col("f") == F.col("root"),
    )
    want = brute(rows, lambda r: None if r[1] is None else r[1].replace("\n", ""))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_manifest_query(spark, tmp_path):
    """The registered query: only documents of an even crc32 are changed; long texts and one row alone."""
    rows = [(i, "a\nb" if i % 3 else None, "en", f"s{i % 4}", i) for i in range(40)] + [(41, "long\n" * 300_000, None, "alone", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    even = lambda r: zlib.crc32(str(r[0]).encode()) % 2 == 0
    want = brute(rows, lambda r: r[1].replace("\n", "") if r[1] and even(r) else r[1])
    got = queries.op11_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r.verified for r in got.collect()} == {True, False}


def test_manifest_levels_share_one_shuffle(spark):
    nodes = spark.range(100).select(
        (F.col("id") % 2).cast("string").alias("key"), F.floor(F.col("id") / 2).alias("rank"), F.lit(50).cast("long").alias("n"),
        F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), F.lit(0).alias("row"),
    )
    plan = manifest.nested(nodes, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
