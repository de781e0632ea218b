"""Language identification: family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportia.llm.common import chunks, stored

#: Families of closely related languages. Any other language is a family of its own.
FAMILIES = (
    ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    ("et", "fi", "hu"),
    ("az", "kk", "tr", "uz"),
    ("ar", "he", "mt"),
    ("bn", "fa", "gu", "hi", "mr", "ne", "pa", "ur"),
)
DIMS, ROWS_PER_LANGUAGE, CHARS_AT_ONCE = 4096, 1500, 1_000_000
STEPS, BATCH, DECAY = 1500, 64, 1e-4
ODD = np.uint32(0x9E3779B1)


def family_of(lang: str) -> str:
    return next((f[0] for f in FAMILIES if lang in f), lang)


def letter_codes() -> np.ndarray:
    """Lower-case code of each letter of the basic plane, 0 of every other character."""
    table = np.zeros(2**16, dtype=np.uint32)
    for code in range(2**16):
        c = chr(code)
        if unicodedata.category(c)[0] == "L":
            table[code] = ord(c.lower()) if len(c.lower()) == 1 else code
    return table


def lowered(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes of lower-case letters, 0 elsewhere; letters beyond the basic plane stay as they are."""
    far = codes >= 2**16
    if not far.any():
        return table[codes]
    out = table[np.where(far, 0, codes)]
    for code in np.unique(codes[far]):
        if unicodedata.category(chr(code))[0] == "L":
            out[codes == code] = code
    return out


def profiles(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter bigrams and trigrams of each whole text, as unit vectors, and whether it has a letter."""
    found = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    size = np.array([len(x) for x in found], dtype=np.int64)
    gap = np.zeros(1, dtype=np.uint32)
    codes = lowered(np.concatenate([y for x in found for y in (gap, x)] + [gap, gap]), table)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), size + 1)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    two = ((a * np.uint32(31) + b) * ODD) >> np.uint32(20)
    three = (((a * np.uint32(31) + b) * np.uint32(8191) + c) * ODD) >> np.uint32(20)
    slot = owner * DIMS
    n = len(texts) * DIMS
    some = (b != 0)[: len(slot)]
    counts = np.bincount((slot + two[: len(slot)])[some], minlength=n) + np.bincount((slot + three[: len(slot)])[some], minlength=n)
    out = np.sqrt(counts.reshape(len(texts), DIMS).astype(np.float32))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    letters = np.bincount(owner, codes[1 : len(owner) + 1] != 0, minlength=len(texts)) > 0
    return out / np.maximum(norm, 1e-9), letters


def svm(x: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
    """Linear machine by averaged sub-gradient steps on the hinge loss; classes weigh the same. The last weight is the bias."""
    pick = np.random.default_rng(seed)
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    plus, minus = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
    w, mean = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(STEPS):
        rows = np.concatenate([pick.choice(plus, BATCH // 2), pick.choice(minus, BATCH // 2)])
        wrong = rows[y[rows] * (x[rows] @ w) < 1]
        w *= 1 - 0.5 / (1 + 0.01 * t) * DECAY
        w += 4.0 / (1 + 0.01 * t) / BATCH * (y[wrong] @ x[wrong])
        if t >= STEPS // 2:
            mean += w
    return (mean / (STEPS - STEPS // 2)).astype(np.float32)


def trainer(table: np.ndarray):
    """One task over the bounded sample: a machine for each pair of families and of languages in a family."""

    def train(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xs, langs, order = [], [], []
        for rows in batches:
            texts = rows["text"].fillna("").tolist()
            for start, end in chunks(texts, CHARS_AT_ONCE):
                xs.append(profiles(texts[start:end], table)[0])
            langs += rows["lang"].tolist()
            order += [(zlib.crc32(b"%d" % d), d) for d in rows["doc_id"]]
        turn = sorted(range(len(order)), key=order.__getitem__)
        out = []
        if turn:
            x, langs = np.vstack(xs)[turn], np.array([langs[i] for i in turn], dtype=object)
            families = np.array([family_of(v) for v in langs], dtype=object)
            for kind, of in (("family", families), ("language", langs)):
                for first, second in combinations(sorted(set(of)), 2):
                    if kind == "language" and family_of(first) != family_of(second):
                        continue
                    rows = (of == first) | (of == second)
                    w = svm(x[rows], np.where(of[rows] == first, 1.0, -1.0), zlib.crc32(f"{first} {second}".encode()))
                    out.append((kind, first, second, w.tolist()))
            out += [("known", v, v, []) for v in sorted(set(langs))]
        yield pd.DataFrame(out, columns=["kind", "first", "second", "weights"])

    return train


def model(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> list[tuple]:
    """Machines learnt from at most ``rows_per_language`` texts of each language, those of the least id digest.

    docs: doc_id, text, lang; rows without a language or text are not learnt from. The chosen ids are stored,
    so that Spark sees how few they are and does not shuffle the texts.
    """
    ids = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = ids.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= rows_per_language)
    chosen = stored(ids.select("doc_id", "lang"))
    sample = docs.select("doc_id", "text", "lang").join(chosen, ["doc_id", "lang"])
    found = sample.repartition(1).mapInPandas(
        trainer(letter_codes()), "kind string, first string, second string, weights array<float>"
    )
    return [tuple(r) for r in found.collect()]


def decided(names: list[str], machines: list[tuple], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name with the most votes for each row, ties by margin, and how sure that is."""
    at = {v: i for i, v in enumerate(names)}
    votes, margin = np.zeros((len(x), len(names))), np.full((len(x), len(names)), 35.0)
    for first, second, w in machines:
        m = x @ w[:-1] + w[-1]
        votes[:, at[first]] += m > 0
        votes[:, at[second]] += m <= 0
        margin[:, at[first]] = np.minimum(margin[:, at[first]], m)
        margin[:, at[second]] = np.minimum(margin[:, at[second]], -m)
    best = np.argmax(votes + margin / 1e3, axis=1) if names else np.zeros(len(x), dtype=int)
    sure = margin[np.arange(len(x)), best] if names else np.zeros(len(x))
    return best, 1 / (1 + np.exp(-np.clip(2 * sure, -35, 35)))


def prediction_of(text: str, machines: list[tuple]) -> Column:
    """Struct of lang_pred and score of a text column, over whole texts.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no language was learnt.
    """
    known = sorted(m[1] for m in machines if m[0] == "known")
    families = sorted({family_of(v) for v in known})
    table = letter_codes()

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ready = [(k, a, b, np.array(w, dtype=np.float32)) for k, a, b, w in machines if k != "known"]
        top = [(a, b, w) for k, a, b, w in ready if k == "family"]
        members = {f: [v for v in known if family_of(v) == f] for f in families}
        within = {f: [(a, b, w) for k, a, b, w in ready if k == "language" and family_of(a) == f] for f in families}
        for batch in batches:
            texts = batch.fillna("").tolist()
            lang, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            for start, end in chunks(texts, CHARS_AT_ONCE) if known else ():
                for s in range(start, end, 256):
                    e = min(end, s + 256)
                    x, letters = profiles(texts[s:e], table)
                    best, sure = decided(families, top, x)
                    for i, f in enumerate(families):
                        rows = np.flatnonzero((best == i) & letters)
                        own, also = decided(members[f], within[f], x[rows])
                        lang[s + rows] = np.array(members[f], dtype=object)[own]
                        score[s + rows] = sure[rows] * also
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return F.pandas_udf(predict, "lang_pred string, score double", F.PandasUDFType.SCALAR_ITER)(F.col(text))


def predicted(docs: DataFrame, machines: list[tuple]) -> DataFrame:
    """doc_id, lang_pred and score of each row; repeated rows are each predicted, other columns are not read."""
    return docs.select("doc_id", prediction_of("text", machines).alias("p")).select("doc_id", "p.lang_pred", "p.score")
