"""Toxicity and language operators: held-out accuracy on the given tables, and odd rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportia.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.1"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@tables
def test_language_held_out(spark):
    got = queries.op6_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.99
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    assert got.count() == docs.count()


@tables
def test_toxicity_held_out(spark):
    """Few labels at this scale: recall is low where words are rare, but clean documents are left alone."""
    got = queries.op3_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    rows = got.select("score", "predicted", "toxic").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) > 0.6 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.01 * len(clean)
    above = sum(np.searchsorted(np.sort([r.score for r in clean]), r.score) for r in toxic)
    assert above > 0.95 * len(toxic) * len(clean)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, "you are vile scum today" if i % 2 else "a fine walk in the park today", "x") for i in range(60)]
        + [(100, None, "x"), (101, "", "x"), (102, "word " * 300_000 + "vile scum", "x"), (1, "you are vile scum today", "x")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (5, None), (None, 1)], "doc_id long, label int")
    weights = toxicity.model(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score_of("text", weights).alias("s")).collect()}
    assert got[1] > 0.7 > 0.3 > got[0] and got[102] > 0.5
    assert got[100] == got[101] and all(0 <= s <= 1 for s in got.values())
    nothing = toxicity.model(docs, labels.limit(0))
    assert {r[0] for r in docs.select(toxicity.score_of("text", nothing)).collect()} == {0.5}
    assert docs.limit(0).select(toxicity.score_of("text", weights)).collect() == []


def test_skip_grams_cross_no_text():
    words = toxicity.Words()
    both = sorted(s for part, _ in toxicity.slots_of(["a b", "c d"], words) for s in part.tolist())
    apart = sorted(s for t in ("a b", "c d") for part, _ in toxicity.slots_of([t], words) for s in part.tolist())
    assert both == apart and len(both) == 6


def test_language_odd_rows(spark):
    say = {"en": "the house and the garden with them", "de": "das haus und der garten mit ihnen", "fr": "la maison et le jardin avec eux",
           "eo": "la domo kaj la gxardeno kun ili", "zz": None}
    rows = [(i, f"{say[k]} {i}" if say[k] else None, k) for i, k in enumerate(list(say) * 12)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    machines = langid.model(docs)
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 34 !"), (4, say["de"] * 20_000), (5, "der garten"), (5, "der garten"), (6, "\U00010330\U00010331 the house"),
         (None, say["fr"]), (2**60 + 1, say["fr"])],
        "doc_id long, text string",
    )
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predicted(odd, machines).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 5, 6)] == ["und", "und", "und", "de", "de", "en"]
    assert langid.predicted(odd, machines).count() == 9 and got[1][1] == 0
    assert got[None][0] == got[2**60 + 1][0] == "fr"
    assert {r.lang_pred for r in langid.predicted(odd, langid.model(docs.limit(0))).collect()} == {"und"}
    assert langid.predicted(odd.limit(0), machines).collect() == []
