"""Benchmark decontamination by spaced seeds: fixed masks ignore some words, hits are verified around."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import chunks, lean, stored
from apportia.llm.toxicity import TOKENS, Words

#: Words at 1 must be equal, words at 0 are ignored. Of any 13 aligned words with at most two unequal, the
#: first two masks find one place or more.
MASKS = ("111111", "11001010011", "1110111")
#: More masks for items of fewer words: with MASKS they find one place of every pattern that 80 % equal words leave.
SHORT_MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "11011", "11101", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "1101011"),
    8: ("11111",),
    10: ("11011011", "111000111", "1101001011"),
    11: ("111001011",),
    12: ("111100101",),
}
ALL_MASKS = (*MASKS, *sorted({m for masks in SHORT_MASKS.values() for m in masks}))
WINDOW, SHARE, CHARS_AT_ONCE, FILTER_BITS = 13, 0.8, 1_000_000, 27
REACH = WINDOW
WIDTH = 2 * REACH + max(map(len, ALL_MASKS))
ODD, MORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SEED_ROWS = "id long, pos int, seed long, near array<int>, size int"


def seeds_of(codes: np.ndarray, owner: np.ndarray, sizes: np.ndarray, short: frozenset[int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, seed) of each place where a mask lies within one text.

    Masks of items of fewer words are used where ``short`` has that number of words; where ``short`` is
    None, each text is an item and takes those of its own number.
    """
    for number, mask in enumerate(ALL_MASKS):
        n = len(codes) - len(mask) + 1
        takes = [k for k, masks in SHORT_MASKS.items() if mask in masks and (short is None or k in short)]
        if n <= 0 or number >= len(MASKS) and not takes:
            continue
        value = np.full(n, number + 1, dtype=np.uint64)
        for at, bit in enumerate(mask):
            if bit == "1":
                value = (value ^ codes[at : at + n]) * ODD
                value ^= value >> np.uint64(31)
        within = owner[:n] == owner[len(mask) - 1 :]
        if number >= len(MASKS) and short is None:
            within &= np.isin(sizes[owner[:n]], takes)
        place = np.flatnonzero(within)
        yield place, value[place]


def bits_of(seed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a seed in the filter."""
    return (seed >> np.uint64(64 - bits)).astype(np.int64), ((seed * MORE) >> np.uint64(64 - bits)).astype(np.int64)


def seeding(bits: int, filled: np.ndarray | None, outside: int, short: frozenset[int] | None = None):
    """Seed rows of texts: id, pos, seed, the words around, and how many words the text has.

    With a filter only the seeds that pass it are given. Words beyond a text's ends are ``outside``. short: the
    numbers of words below 13 that items have; None where the texts are the items.
    """

    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for rows in batches:
            texts, ids = rows["text"].fillna("").tolist(), rows["id"].to_numpy()
            for start, end in chunks(texts, CHARS_AT_ONCE):
                found = [[words[w] for w in TOKENS.findall(t.lower())] for t in texts[start:end]]
                sizes = np.array([len(x) for x in found])
                owner = np.repeat(np.arange(len(found)), sizes)
                codes = np.array([c for x in found for c in x], dtype=np.uint64)
                first = np.cumsum(sizes) - sizes
                padded = np.concatenate([np.zeros(REACH, np.uint64), codes, np.zeros(WIDTH, np.uint64)]).astype(np.int64)
                whose = np.concatenate([np.full(REACH, -1), owner, np.full(WIDTH, -1)])
                for place, seed in seeds_of(codes, owner, sizes, short):
                    if filled is not None:
                        a, b = bits_of(seed, bits)
                        hit = (filled[a >> 3] >> (a & 7)) & (filled[b >> 3] >> (b & 7)) & 1
                        place, seed = place[hit > 0], seed[hit > 0]
                    for s in range(0, len(place), 20_000):
                        p, own = place[s : s + 20_000], owner[place[s : s + 20_000]]
                        at = p[:, None] + np.arange(WIDTH)
                        near = np.where(whose[at] == own[:, None], padded[at] & 0x7FFFFFFF, outside).astype(np.int32)
                        yield pd.DataFrame({
                            "id": ids[start + own], "pos": (p - first[own]).astype(np.int32),
                            "seed": seed[s : s + 20_000].view(np.int64), "near": list(near),
                            "size": sizes[own].astype(np.int32),
                        })

    return rows_of


def places(bits: int):
    def words_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            both = np.concatenate(bits_of(rows["seed"].to_numpy(np.int64).view(np.uint64), bits))
            yield pd.DataFrame({"at": both >> 3, "bit": (1 << (both & 7)).astype(np.int32)})

    return words_of


def filter_of(seeds: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of 2**bits bits in which the seeds are set: a fixed size, whatever the number of seeds."""
    filled = np.zeros(2 ** (bits - 3), dtype=np.uint8)
    found = seeds.select("seed").mapInPandas(places(bits), "at long, bit int").groupBy("at").agg(F.bit_or("bit").alias("bit"))
    for row in found.toLocalIterator():
        filled[row["at"]] = row["bit"]
    return filled


def verified(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Most equal words in any window over the aligned words around a hit, kept where they are enough."""
    for rows in batches:
        if not len(rows):
            continue
        equal = np.stack(rows["near"].to_numpy()) == np.stack(rows["item_near"].to_numpy())
        total = np.concatenate([np.zeros((len(rows), 1), dtype=np.int64), np.cumsum(equal, axis=1)], axis=1)
        most = (total[:, WINDOW:] - total[:, :-WINDOW]).max(axis=1)
        need = np.ceil(SHARE * np.minimum(WINDOW, rows["item_size"].to_numpy()) - 1e-9)
        kept = most >= need
        yield pd.DataFrame({
            "doc_id": rows["id"][kept], "item_id": rows["item_id"][kept], "pos": rows["pos"][kept],
            "matched": most[kept].astype(np.int32),
        })


def overlaps(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Benchmark items that documents repeat: doc_id, item_id, n_hits, matched, first_word, last_word.

    An overlap is a run of 13 aligned words (of all words of a shorter item) of which 80 % are equal; the masks
    have a hit in every such run. Words are runs of letters and digits in lower case. matched is the most
    equal words of a run.

    Seeds of the benchmark set bits in a filter of fixed size, which every task gets; only seeds of
    documents that pass it are shuffled to the exact join. Null and empty texts overlap nothing, rows without
    an id are not looked at (give them one to have them compared), repeated rows of a document count once,
    empty tables give no rows, other columns are not read.
    """
    items = benchmark.select(F.col("item_id").alias("id"), "text").where("id is not null")
    known = stored(items.mapInPandas(lean(seeding(filter_bits, None, -2)), SEED_ROWS))
    filled = docs.sparkSession.sparkContext.broadcast(filter_of(known, filter_bits))
    short = frozenset(r["size"] for r in known.where(F.col("size") < WINDOW).select("size").distinct().collect())

    def hits_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from seeding(filter_bits, filled.value, -1, short)(batches)

    hits = docs.select(F.col("doc_id").alias("id"), "text").where("id is not null").mapInPandas(lean(hits_of), SEED_ROWS)
    item = known.select("seed", F.col("id").alias("item_id"), F.col("near").alias("item_near"), F.col("size").alias("item_size"))
    checked = hits.drop("size").join(item, "seed").mapInPandas(
        lean(verified), "doc_id long, item_id long, pos int, matched int"
    )
    return checked.groupBy("doc_id", "item_id").agg(
        F.count_distinct("pos").alias("n_hits"), F.max("matched").alias("matched"),
        F.min("pos").alias("first_word"), F.max("pos").alias("last_word"),
    )


def brute_overlaps(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> set[tuple[int, int]]:
    """Pairs that overlap by the definition, each diagonal of each pair compared; for tests on a few texts."""
    words = lambda t: TOKENS.findall((t or "").lower())
    out = set()
    for i, item in items:
        b = words(item)
        need = math.ceil(SHARE * min(WINDOW, len(b)) - 1e-9)
        for d, text in docs:
            a = words(text)
            for shift in range(-len(b), len(a)):
                equal = [0 <= shift + j < len(a) and a[shift + j] == b[j] for j in range(len(b))]
                if b and any(sum(equal[s : s + WINDOW]) >= need for s in range(max(1, len(b) - WINDOW + 1))):
                    out.add((d, i))
    return out
