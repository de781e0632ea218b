"""Quality: hashed word and character n-gram vectors, averaged per document, under a softmax output."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import chunks, stored

#: Slots of the vector table, numbers in a vector, and letters of a character n-gram.
SLOTS, DIM, LETTERS = 2**17, 16, (3, 4)
ROWS_PER_LABEL, EPOCHS, LEAST_TEXTS = 3000, 12, 2
#: First rates of the output and of the mean vector of a document.
RATE, MEAN_RATE = 1.0, 0.1
WORDS_KEPT, LETTERS_KEPT, CHARS_AT_ONCE = 200_000, 64, 500_000
ODD = np.uint64(0x9E3779B97F4A7C15)
Model = tuple[np.ndarray, np.ndarray]


def spaces() -> np.ndarray:
    """Whether each code of the basic plane is white space; there is none beyond it."""
    return np.array([chr(c).isspace() for c in range(2**16)])


def gram_slots(texts: list[str], space: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size of n-gram: its slot at every place, and whether one begins there; and then where texts begin.

    An n-gram lies within a word; the mark of a word's end counts as a letter, so that "a" has one of three.
    """
    codes = np.frombuffer("".join(["\n", *[x for t in texts for x in (t, "\n")]]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    near = codes < 2**16
    x = np.where(near & space[np.where(near, codes, 0)], np.uint32(0), codes)
    inner = x != 0
    for n in LETTERS:
        size = len(x) - n + 1
        if size <= 0:
            yield np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
            continue
        mixed, whole = np.full(size, n, dtype=np.uint32), np.ones(size, dtype=bool)
        for i in range(n):
            mixed = mixed * np.uint32(8191) + x[i : i + size]
            mixed ^= mixed >> np.uint32(13)
            if 0 < i < n - 1:
                whole &= inner[i : i + size]
        yield (mixed * np.uint32(0x9E3779B1) >> np.uint32(15)).astype(np.int64), whole


def digest(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def word_slots(digests: np.ndarray) -> np.ndarray:
    """Slots of words as they are written."""
    return ((digests * ODD) >> np.uint64(47)).astype(np.int64)


def pair_slots(digests: np.ndarray) -> np.ndarray:
    """Slots of the word bigrams of a text; all pairs of a word with itself share one."""
    first, second = digests[:-1], digests[1:]
    mixed = (first * ODD ^ (first >> np.uint64(7))) + second * np.uint64(31)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * ODD
    return np.where(first == second, np.uint64(0), mixed >> np.uint64(20)).astype(np.int64) % SLOTS


class Words(dict):
    """Digest of each word met; emptied when it has grown large, and long words are not kept."""

    def __missing__(self, word: str) -> int:
        value = digest(word)
        if len(word) <= LETTERS_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = value
        return value


def counted(text: str, words: Words, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text, each once, and the share of the text's features that each has."""
    digests = np.array([words[w] for w in text.split()], dtype=np.uint64)
    if not len(digests):
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    grams = [s[m] for s, m in gram_slots([text], space)]
    slots, times = np.unique(np.concatenate([word_slots(digests), pair_slots(digests), *grams]), return_counts=True)
    return slots.astype(np.int32), (times / times.sum()).astype(np.float32)


def slots_of(text: str) -> Column:
    """Struct of slots and shares of a text column."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words, space = Words(), spaces()
        for batch in batches:
            found = [counted(t, words, space) for t in batch.fillna("")]
            yield pd.DataFrame({"slots": [s for s, _ in found], "shares": [w for _, w in found]})

    return F.pandas_udf(count, "slots array<int>, shares array<float>", F.PandasUDFType.SCALAR_ITER)(F.col(text))


def mean_odds(texts: list[str], odds: np.ndarray, words: Words, space: np.ndarray) -> np.ndarray:
    """Mean odds of the features of each text, 0 where it has none."""
    found = [[words[w] for w in t.split()] for t in texts]
    size = np.array([len(x) for x in found], dtype=np.int64)
    digests = np.array([d for x in found for d in x], dtype=np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)
    total = np.bincount(owner, odds[word_slots(digests)], minlength=len(texts))
    number = size + np.maximum(size - 1, 0)
    if len(digests) > 1:
        same = owner[:-1] == owner[1:]
        total += np.bincount(owner[1:][same], odds[pair_slots(digests)][same], minlength=len(texts))
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    for slots, whole in gram_slots(texts, space):
        if len(slots):
            at = np.minimum(starts, len(slots) - 1)
            some = np.where(starts < len(slots), 1, 0)
            total += np.add.reduceat(np.where(whole, odds[slots], 0.0), at) * some
            number = number + np.add.reduceat(whole.astype(np.int64), at) * some
    return total / np.maximum(number, 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(slots: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of slots and of the two labels, by stochastic gradient descent, one document a step.

    Labels weigh the same, whatever their number of documents. The rate falls to 0 in a line. A slot met in
    one document only keeps the zero vector: it tells nothing of others.
    """
    pick = np.random.default_rng(seed)
    vectors = pick.uniform(-1 / DIM, 1 / DIM, (SLOTS, DIM)).astype(np.float32)
    out = np.zeros((2, DIM), dtype=np.float32)
    texts = np.zeros(SLOTS, dtype=np.int32)
    for s in slots:
        texts[s] += 1
    vectors[texts < LEAST_TEXTS] = 0
    rows = [(s[keep], w[keep][:, None]) for s, w in zip(slots, shares) for keep in [texts[s] >= LEAST_TEXTS]]
    weight = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in pick.permutation(len(labels)):
            s, w = rows[i]
            rate = RATE * (1 - done / steps) * weight[labels[i]]
            done += 1
            held = vectors[s]
            mean = (w * held).sum(axis=0)
            wrong = softmax(out @ mean)
            wrong[labels[i]] -= 1
            back = wrong @ out
            out -= rate * np.outer(wrong, mean)
            # The step of the mean, dealt out to the slots by their shares.
            vectors[s] = held - rate * MEAN_RATE / max(float((w * w).sum()), 1e-6) * w * back
    return vectors, out


def trained_on(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task over the bounded sample: what each slot adds to the odds of label 1."""
    slots, shares, labels, order = [], [], [], []
    for rows in batches:
        slots += [np.array(s, dtype=np.int32) for s in rows["slots"]]
        shares += [np.array(w, dtype=np.float32) for w in rows["shares"]]
        labels += rows["label"].tolist()
        order += rows["place"].tolist()
    turn = np.argsort(np.array(order, dtype=np.int64), kind="stable")
    labels = np.array(labels, dtype=np.int64)[turn]
    if len(set(labels.tolist())) == 2:
        vectors, out = fit([slots[i] for i in turn], [shares[i] for i in turn], labels)
        odds = vectors @ (out[1] - out[0])
        some = np.flatnonzero(odds)
        yield pd.DataFrame({"slot": some, "odds": odds[some].astype(np.float64)})


def model(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> Model:
    """Slots and their odds, learnt from at most ``rows_per_label`` documents of each label, of the least id digest.

    docs: doc_id, text. labels: doc_id, label (0 or 1; null labels are left out; the larger of several). The
    slots of texts are found where the texts are; one task gets numbers only. Rows that repeat an id are all
    learnt from, so ids should be unique; without both labels nothing is learnt. The result has at most
    ``SLOTS`` numbers, whatever the size of the input.
    """
    ids = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    least = [
        ids.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_label) for v in (0, 1)
    ]
    chosen = stored(least[0].unionByName(least[1]))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    placed = sample.select(F.xxhash64("doc_id", "text").alias("place"), "label", slots_of("text").alias("found"))
    found = placed.select("place", "label", "found.*").repartition(1).mapInPandas(trained_on, "slot long, odds double").collect()
    return np.array([r[0] for r in found], dtype=np.int64), np.array([r[1] for r in found], dtype=np.float64)


def score_of(text: str, learnt: Model) -> Column:
    """Probability of label 1 for a text column: the mean odds of the features of the whole text.

    Null and empty texts have no feature and score 0.5, as does every text if nothing was learnt. Repeated
    rows score alike; a very long text is scored whole, and its words stay in its task.
    """
    slots, values = learnt

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        odds = np.zeros(SLOTS)
        odds[slots] = values
        words, space = Words(), spaces()
        for batch in batches:
            texts, out = batch.fillna("").tolist(), np.zeros(len(batch))
            for start, end in chunks(texts, CHARS_AT_ONCE):
                out[start:end] = mean_odds(texts[start:end], odds, words, space)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return F.pandas_udf(score, "double", F.PandasUDFType.SCALAR_ITER)(F.col(text))
