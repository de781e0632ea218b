"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import chunks, lean

BITS, SAMPLE_ROWS, EPOCHS, LEAST_TEXTS = 20, 30_000, 6, 3
ALPHA, BETA, L1, L2 = 4.0, 1.0, 5.0, 0.5
GAPS = (0, 1, 2, 3)
TOKENS = re.compile(r"[^\W_]+")
CHARS_AT_ONCE, WORDS_KEPT = 1_000_000, 100_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Digest of each word met; emptied when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = value = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return value


def slots_of(texts: list[str], words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slot, position of the text) of every word and of every pair of words at most three apart."""
    found = [[words[w] for w in TOKENS.findall(t.lower())] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in found])
    digest = np.array([d for x in found for d in x], dtype=np.uint64) * ODD
    for gap in GAPS:
        if gap >= len(digest) and gap:
            continue
        if gap == 0:
            mixed, own = digest, owner
        else:
            mixed = (digest[:-gap] ^ (digest[:-gap] >> np.uint64(29))) * np.uint64(2 * gap + 1) + digest[gap:]
            same = owner[:-gap] == owner[gap:]
            mixed, own = mixed[same], owner[gap:][same]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * ODD
        yield (mixed >> np.uint64(64 - BITS)).astype(np.int64), own


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(examples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights; slot 2**BITS is the bias. Per-coordinate rates, L1 makes most weights exactly zero.

    Slots met in fewer than LEAST_TEXTS examples are not learnt from.
    """
    z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
    texts = np.zeros(2**BITS + 1, dtype=np.int32)
    for slots in examples:
        texts[slots] += 1
    for i, slots in enumerate(examples):
        examples[i] = slots[texts[slots] >= LEAST_TEXTS]

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) > L1, w, 0.0)

    for _ in range(epochs):
        for slots, y in zip(examples, labels):
            w = weights(slots)
            g = float(logistic(w.sum())) - y
            step = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / ALPHA
            z[slots] += g - step * w
            n[slots] += g * g
    w = weights(np.arange(len(z)))
    kept = np.flatnonzero(w)
    return kept, w[kept]


def slots_in(text: str) -> Column:
    """Slots of a text column, each once, in 32 bits."""

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words()
        for batch in batches:
            out = []
            for t in batch.fillna(""):
                parts = [s for s, _ in slots_of([t], words)]
                out.append(np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.zeros(0, dtype=np.int32))
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(lean(find), "array<int>", F.PandasUDFType.SCALAR_ITER)(F.col(text))


def trained_on(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task over the bounded sample: weights by slot."""
    examples, labels, order = [], [], []
    bias = np.array([2**BITS], dtype=np.int32)
    for rows in batches:
        examples += [np.concatenate([np.asarray(s, dtype=np.int32), bias]) for s in rows["slots"]]
        labels += rows["label"].tolist()
        order += zip(rows["place"].tolist(), rows["tie"].tolist())
    turn = sorted(range(len(order)), key=order.__getitem__)
    placed = [examples[i] for i in turn]
    del examples
    kept, w = fit(placed, np.array([float(labels[i]) for i in turn]))
    yield pd.DataFrame({"slot": kept.astype(np.int64), "weight": w})


def model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Weights learnt from at most ``sample_rows`` labelled documents, those of the least id digest.

    docs: doc_id, text. labels: doc_id, label (0 or 1; null labels are left out; the larger of several).
    Slots are found where the texts are, so that the one task that learns gets numbers only: four bytes for each
    distinct slot of a text, however long. Rows that repeat an id are each learnt from; other columns are not
    read. The weights are at most 2**BITS numbers, whatever the size of the input.
    """
    ids = (
        labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(
        F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("place"), F.xxhash64("doc_id", "text").alias("tie"), "label",
        slots_in("text").alias("slots"),
    )
    found = sample.repartition(1).mapInPandas(lean(trained_on), "slot long, weight double").collect()
    return np.array([r[0] for r in found], dtype=np.int64), np.array([r[1] for r in found], dtype=np.float64)


def score_of(text: str, weights: tuple[np.ndarray, np.ndarray]) -> Column:
    """Score of a text column, over whole texts.

    Null and empty texts hold no word and get the score of the bias; without labels every score is 0.5. Repeated
    rows score alike; texts of any length are scored whole, some at a time; an empty table gives no scores.
    """
    slots, values = weights

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(2**BITS + 1)
        dense[slots] = values
        some, words = dense != 0, Words()
        for batch in batches:
            texts = batch.fillna("").tolist()
            total = np.full(len(texts), dense[2**BITS])
            for start, end in chunks(texts, CHARS_AT_ONCE):
                hits = [(s[m], o[m]) for s, o in slots_of(texts[start:end], words) for m in [some[s]]]
                if hits:
                    pairs = np.unique(np.concatenate([o * 2**BITS + s for s, o in hits]))
                    own = pairs >> BITS
                    total[start:end] += np.bincount(own, dense[pairs & (2**BITS - 1)], minlength=end - start)
            yield pd.Series(logistic(total))

    return F.pandas_udf(lean(score), "double", F.PandasUDFType.SCALAR_ITER)(F.col(text))
