"""Quality classifier: held-out accuracy, scores again in plain Python, a fit on a few rows, and odd rows."""

import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportia.llm import quality, queries

SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_quality_held_out(spark):
    got = queries.op12_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    rows = got.select("score", "predicted", "quality").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) > 0.99 * len(good)
    assert sum(r.predicted for r in bad) < 0.05 * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def documents(spark):
    texts = ["the cat sat on the mat", "the dog sat on a rug", "&&& the$$$ cat### sat***", "buy### now$$$ the&&& rug"]
    rows = [(i, f"{texts[i % 4]} {i}", "x", "x") for i in range(80)]
    odd = [(100, None), (101, ""), (102, " \n\t "), (103, "the cat sat on a rug " * 50_000), (104, "&&&$$$" * 100_000), (3, "the dog sat"), (None, "the dog sat"), (2**60 + 1, "퟿\U00010330 cat")]
    return spark.createDataFrame(rows + [(i, t, "x", "x") for i, t in odd], "doc_id long, text string, score string, label string")


def test_quality_scores_again(spark):
    """Features and mean written out in plain Python."""
    docs = documents(spark)
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(80)], "doc_id long, label int")
    learnt = quality.model(docs, labels)
    odds = dict(zip(learnt[0].tolist(), learnt[1].tolist()))
    odd, whole = int(quality.ODD), 2**64

    def brute(text):
        words, slots = (text or "").split(), []
        digests = [zlib.crc32(w.encode()) for w in words]
        for w, d in zip(words, digests):
            slots.append((d * odd) % whole >> 47)
            codes = [0, *map(ord, w), 0]
            for n in (3, 4):
                for i in range(len(codes) - n + 1):
                    x = n
                    for c in codes[i : i + n]:
                        x = (x * 8191 + c) % 2**32
                        x ^= x >> 13
                    slots.append((x * 0x9E3779B1) % 2**32 >> 15)
        for a, b in zip(digests, digests[1:]):
            x = (((a * odd) % whole ^ (a >> 7)) + b * 31) % whole
            x = ((x ^ (x >> 32)) * odd) % whole
            slots.append(0 if a == b else (x >> 20) % quality.SLOTS)
        mean = sum(odds.get(s, 0.0) for s in slots) / len(slots) if slots else 0.0
        return 1 / (1 + math.exp(-mean))

    rows = docs.select("doc_id", "text", quality.score_of("text", learnt).alias("s")).collect()
    for r in rows:
        if r.text is None or len(r.text) < 1000:
            assert r.s == pytest.approx(brute(r.text), abs=1e-9), r
    got = {r.doc_id: r.s for r in rows}
    assert got[100] == got[101] == got[102] == 0.5
    assert got[0] > 0.9 > 0.1 > got[2] and got[103] > 0.7 > 0.3 > got[104]
    assert len(rows) == docs.count()


def test_quality_learns_nothing_without_both_labels(spark):
    docs = documents(spark)
    for labels in ([], [(1, 1), (2, 1)], [(1, None), (None, 0), (2, 7)]):
        learnt = quality.model(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        assert {r[0] for r in docs.select(quality.score_of("text", learnt)).collect()} == {0.5}
    assert docs.limit(0).select(quality.score_of("text", (np.zeros(0, dtype=np.int64), np.zeros(0)))).collect() == []


def test_quality_fit_is_gradient_descent():
    """The first step, worked out by hand: outputs start at zero, so only they move, by the share of the label."""
    s, w = [np.array([1, 2]), np.array([1, 2])], [np.array([0.5, 0.5], dtype=np.float32)] * 2
    start = np.random.default_rng(7).uniform(-1 / quality.DIM, 1 / quality.DIM, (quality.SLOTS, quality.DIM)).astype(np.float32)
    vectors, out = quality.fit(s, w, np.array([0, 1]), epochs=0)
    assert (out == 0).all() and np.array_equal(vectors[1], start[1]) and (vectors[3] == 0).all()
    vectors, out = quality.fit(s[:1] * 2, w, np.array([1, 1]), epochs=1)
    mean = start[[1, 2]].mean(axis=0)
    assert np.sign(out[1] @ mean) == 1 and np.sign(out[0] @ mean) == -1


def test_quality_takes_the_same_sample_again(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(80)], "doc_id long, label int")
    first, again = quality.model(docs, labels, 10), quality.model(docs.repartition(7), labels.repartition(5), 10)
    assert np.array_equal(first[0], again[0]) and np.array_equal(first[1], again[1])
    assert not np.array_equal(first[1], quality.model(docs, labels, 30)[1])
    assert docs.where(F.col("doc_id") == 3).count() == 2
