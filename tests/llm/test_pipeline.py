"""The pipeline against its stages done by brute force, and odd tables."""

import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from apportia.llm import decontamination, lines, toxicity
from apportia.llm.sql import MIX_SQL
from tests.llm.test_duplicates import brute_classes, brute_lines, sentence

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, gone string"


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    pick = random.Random(21)
    docs, bench = [], [(i, sentence(pick, 20)) for i in range(4)]
    shared = "\n".join(sentence(pick, 12) for _ in range(3))
    for i in range(240):
        text = "\n".join(sentence(pick, pick.randint(3, 30)) for _ in range(pick.randint(1, 6)))
        kind = i % 12
        if kind == 1:
            text += " vile scum of the " + sentence(pick, 4)
        elif kind == 2:
            text += "\n" + shared
        elif kind == 3:
            text += " " + bench[i % 4][1]
        elif kind == 4 and i > 12:
            words = docs[-12][1].split(" ")
            words[pick.randrange(len(words))] = "edit"
            text = " ".join(words)
        elif kind == 5 and i > 12:
            text = docs[-12][1]
        docs.append((i, text))
    docs += [(7, docs[8][1] + " and a text of its own under an id that others have"), (None, docs[9][1]), (None, bench[0][1]), (None, sentence(pick, 30))]
    docs += [(900, None), (901, ""), (902, " \n"), (903, "!!!"), (904, "!!!"), (7, docs[7][1]), (905, docs[0][1])]
    sources = ["hot"] * 8 + ["a", "b", None]
    rows = [(d, t, "en", sources[n % len(sources)], len(t or ""), "x") for n, (d, t) in enumerate(docs)]
    labels = [(i, 1, int(i % 12 == 1)) for i in range(0, 240) if i % 3]
    return tmp_path_factory.mktemp("tables"), rows, labels, bench


def written(spark, folder, rows, labels, bench):
    spark.createDataFrame(rows, COLUMNS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_brute(spark, tables):
    folder, rows, labels, bench = tables
    sf = written(spark, folder, rows, labels, bench)
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    slots, values = toxicity.model(docs, spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("toxic", "label"))
    weight = dict(zip(slots.tolist(), values.tolist()))
    score = lambda t: weight.get(2**toxicity.BITS, 0.0) + sum(
        weight.get(s, 0.0) for s in {s for part, _ in toxicity.slots_of([t or ""], toxicity.Words()) for s in part.tolist()}
    )
    kept = [r for r in rows if toxicity.logistic(np.array([score(r[1])]))[0] < corpus_pipeline.TOXIC]
    assert 15 <= len(rows) - len(kept) <= 25

    left = brute_lines([(r[0], r[1]) for r in kept], lines.RARE_WORDS)
    reduced = []
    for r in kept:
        text = left.get((r[0], r[1]), r[1])
        if text == r[1]:
            reduced.append(r)
        elif text.strip(" "):
            reduced.append((r[0], text, r[2], r[3], len(text), r[5]))
    assert len(reduced) < len(kept)

    order = sorted({(r[0], r[1]) for r in reduced}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    place = {r: i for i, r in enumerate(order)}
    found = brute_classes([(i, t) for i, (_, t) in enumerate(order)])
    first, one = {d for d, c, _, _ in found if d == c}, {}
    for r in reduced:
        if place[r[0], r[1]] in first:
            one.setdefault((r[0], r[1]), r)
    hit = {d for d, _ in decontamination.brute_overlaps([(place[k], k[1]) for k in one], bench)}
    want = [r for k, r in one.items() if place[k] not in hit]
    assert len(hit) >= 16 and len(one) < len(reduced)
    assert len([r for r in want if r[0] == 7]) >= 1 and len([r for r in want if r[0] is None]) >= 1
    assert any(k[0] is None and place[k] in hit for k in one)

    stages = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES, (kept, reduced, list(one.values()), want)):
        stages = corpus_pipeline.stored(stage(spark, stages, sf))
        assert stages.columns == docs.columns
        got = sorted(map(tuple, stages.collect()), key=repr)
        assert got == sorted(expected, key=repr), name

    con = duckdb.connect()
    import pandas as pd

    documents = pd.DataFrame(want, columns=docs.columns).astype({"doc_id": "Int64"})  # noqa: F841
    order_of = "md5('17:' || CAST(doc_id AS VARCHAR))"
    assert order_of in MIX_SQL
    null_safe = MIX_SQL.replace(order_of, "md5(concat_ws(':', '17', CAST(doc_id AS VARCHAR)))")
    mixed = {tuple(r) for r in con.execute(null_safe).fetchall()}
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert {(a, b, c, round(d, 6), e) for a, b, c, d, e in map(tuple, got.collect())} == {(a, b, c, round(d, 6), e) for a, b, c, d, e in mixed}
    assert got.count() == len(want)


def test_pipeline_of_empty_tables(spark, tables, tmp_path):
    _, rows, labels, bench = tables
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "a", [], labels, bench)).collect() == []
    got = corpus_pipeline.run(spark, written(spark, tmp_path / "b", rows[:40], [], [])).collect()
    assert 30 <= len(got) <= 40
