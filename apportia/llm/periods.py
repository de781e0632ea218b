"""Periodic runs of words: documents are cut into overlapping tiles for each octave of periods."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import stored

#: Boundaries of a tile lie in a core of CORE words at least, and of CORE_BLOCKS times the octave's least period.
CORE, CORE_BLOCKS = 8192, 8
LEAST_WORDS, LEAST_TIMES, CHARS_AT_ONCE = 6, 4, 4_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)
KEY, TILE = ["doc", "digest"], ["low", "high", "core", "stop", "start"]
#: A row of a document has ``plain``; one of a tile has the columns of ``TILE`` and the tile's words.
OPENED = "doc string, digest long, n long, plain string, words string, fragments array<array<long>>, " + ", ".join(f"{c} long" for c in TILE)
FRAGMENTS = "doc string, digest long, period long, first long, last long"


def octaves(n: int) -> int:
    """Octaves of the periods that fit four times into n words; octave k has 2^k to 2^(k+1) - 1."""
    return (n // LEAST_TIMES).bit_length()


def tiles(n: int, core: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(low, high, core, stop, start, end) of the tiles of n words: octaves low to high - 1, boundaries in core to stop, words start to end.

    Short octaves share tiles. A tile sees one block of words before its core and four beyond it, all that its
    boundaries need, so tiles are solved apart.
    """
    top, low = octaves(n), 0
    while low < top:
        high = low + 1
        size = max(core, CORE_BLOCKS << low)
        while high < top and CORE_BLOCKS << high <= size:
            high += 1
        block = 1 << (high - 1)
        for at in range(0, n, size):
            yield low, high, at, min(n, at + size), max(0, at - block), min(n, at + size + 4 * block)
        low = high


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit digests of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def solved(ids: np.ndarray, low: int, high: int, core: int, stop: int, start: int, n: int) -> list[tuple[int, int, int]]:
    """(period, first, last) of stretches of places i with equal words at i and i + period, through a core's boundaries.

    In octave k boundaries are the multiples of 2^k. Digests of 2^k words, made from those of half as many,
    say for each boundary and period whether a block of 2^k words is met again a period later. From there the
    Z-function of the boundary, forwards and backwards, goes on for less than a block, halving the steps. What
    touches no end of the core and is shorter than three periods is no run; the rest is for stitching.
    """
    if not high:
        return []
    size = len(ids)
    pad = 4 << (high - 1)
    # Digests beyond the tile are unlike all others.
    level = mixed(np.concatenate([ids, np.uint64(1 << 63) + np.arange(pad, dtype=np.uint64)]))
    levels, found = [], []
    for k in range(high):
        block = 1 << k
        if k:
            half = block >> 1
            level = mixed(levels[-1][:-half] * ODD + levels[-1][half:])
        levels.append(level)
        if k < low:
            continue
        bounds = np.arange(-(-core // block) * block, stop, block, dtype=np.int64) - start
        bounds = bounds[bounds + block <= size]
        if not len(bounds):
            continue
        periods = np.arange(block, 2 * block, dtype=np.int64)
        met = level[bounds] == level[np.minimum(bounds + periods[:, None], len(level) - 1)]
        if not met.any():
            continue
        edge = np.zeros((block, 1), dtype=np.int8)
        change = np.diff(met.astype(np.int8), axis=1, prepend=edge, append=edge)
        p, i = np.nonzero(change == 1)
        j = np.nonzero(change == -1)[1] - 1
        period, first, last = periods[p], bounds[i], bounds[j] + block
        for step in reversed(range(k)):
            reach = 1 << step
            own, back = levels[step], first - reach
            first = np.where((back >= 0) & (own[np.maximum(back, 0)] == own[np.maximum(back, 0) + period]), back, first)
            on = np.minimum(last + period, len(own) - 1)
            last = np.where(own[np.minimum(last, len(own) - 1)] == own[on], last + reach, last)
        open_left = (i == 0) & (start + first > 0) & (first <= bounds[i] - block + 1)
        open_right = (j == len(bounds) - 1) & (start + last + period < n) & (last >= bounds[j] + 2 * block - 1)
        some = open_left | open_right | (last - first >= (LEAST_TIMES - 1) * period)
        found += zip(period[some].tolist(), (start + first[some]).tolist(), (start + last[some]).tolist())
    return found


def planted(words: list[bytes], start: int, period: int) -> list[bytes]:
    """Words from ``start`` on replaced by the ``period`` words there, again and again."""
    rest = len(words) - start
    return words[:start] + (words[start : start + period] * -(-rest // period))[:rest]


def framed(out: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=[*KEY, "n", "plain", "words", "fragments", *TILE])
    return frame.astype({c: "Int64" for c in TILE})


def opened(core: int):
    """Documents: those of one tile are solved; of longer ones each tile is a row besides their own."""

    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out, held = [], 0
            for doc, digest, text, start, period in zip(*[rows[c] for c in (*KEY, "text", "start", "period")]):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if period and n:
                    words = planted(words, start, period)
                whole = b" ".join(words)
                one = n <= core
                fragments = solved(numbered(words), 0, octaves(n), 0, n, 0, n) if one else []
                kept = None if one and not fragments else whole.decode("utf-8", "surrogatepass")
                out.append((doc, digest, n, hashlib.sha256(whole).hexdigest(), kept, fragments, *[None] * len(TILE)))
                held += len(kept or "") + 200
                for low, high, at, stop, a, b in () if one else tiles(n, core):
                    part = b" ".join(words[a:b]).decode("utf-8", "surrogatepass")
                    out.append((doc, digest, n, None, part, [], low, high, at, stop, a))
                    held += len(part)
                    if held > CHARS_AT_ONCE:
                        yield framed(out)
                        out, held = [], 0
                if held > CHARS_AT_ONCE:
                    yield framed(out)
                    out, held = [], 0
            yield framed(out)

    return rows_of


def solve_tiles(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for doc, digest, n, words, *tile in zip(*[rows[c] for c in (*KEY, "n", "words", *TILE)]):
            low, high, core, stop, start = map(int, tile)
            found = solved(numbered(words.encode("utf-8", "surrogatepass").split(b" ")), low, high, core, stop, start, int(n))
            out += [(doc, digest, *x) for x in found]
        yield pd.DataFrame(out, columns=[*KEY, "period", "first", "last"])


def runs_of(fragments: DataFrame) -> DataFrame:
    """One row (doc, digest, start, period, length) for each run; fragments: doc, digest, period, first, last.

    Fragments of a document and period that touch or overlap are one stretch; it is a run if the words it
    spans are long enough. Of periods with the same span the smallest is the run's, the others its multiples.
    """
    parts = fragments.groupBy(*KEY, "period").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("parts"))
    nothing = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def stitch(done: Column, part: Column) -> Column:
        end = F.try_element_at(done, F.lit(-1))
        joined = F.struct(end["first"].alias("first"), F.greatest(end["last"], part["last"]).alias("last"))
        return F.when(part["first"] <= end["last"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(part))
        )

    whole = F.when(F.size("parts") == 1, F.col("parts")).otherwise(F.aggregate("parts", nothing, stitch))
    spans = parts.select(*KEY, "period", F.explode(whole).alias("s")).select(
        *KEY, "period", F.col("s.first").alias("start"), (F.col("s.last") - F.col("s.first") + F.col("period")).alias("length")
    )
    long_enough = (F.col("length") >= LEAST_WORDS) & (F.col("length") >= LEAST_TIMES * F.col("period"))
    return spans.where(long_enough).groupBy(*KEY, "start", "length").agg(F.min("period").alias("period"))


def collapsed(text: str, runs: str) -> Column:
    """The words that no run drops, joined by spaces: each run keeps its first period. Null where there is no run."""

    def collapse(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for t, first, last in zip(texts, starts, ends):
            if first is None:
                out.append(None)
                continue
            words = t.split(" ")
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, np.asarray(first, dtype=np.int64), 1)
            np.subtract.at(change, np.asarray(last, dtype=np.int64), 1)
            out.append(" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]))
        return pd.Series(out, dtype=object)

    starts = F.transform(runs, lambda r: r["start"] + r["period"])
    ends = F.transform(runs, lambda r: r["start"] + r["length"])
    return F.pandas_udf(collapse, "string", F.PandasUDFType.SCALAR)(F.col(text), starts, ends)


def periodic(docs: DataFrame, core: int = CORE) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, period, length, in this order), ``kept`` and collapsed_sha256 of each row.

    docs: doc_id (a number or text), text, and ``start`` and ``period``: words from ``start`` on become the
    ``period`` words there, again and again; a null period leaves them as they are. Words stand between white
    space of ASCII. A run is a stretch of words with smallest period q, of 6 words and 4 q at least, that no
    neighbouring word extends. ``kept`` has the words less what runs repeat, and is null where there is no run.

    Null and empty texts have no word and no run. Documents beyond ``core`` words give rows for their tiles,
    which are dealt out and solved apart, however long the text; fragments meet by document and period. Rows
    of one id are told apart by a digest of their text, equal ones share their runs; null ids are ids. An
    empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("doc"),
        F.xxhash64("text", "start", "period").alias("digest"), "text",
        F.coalesce(F.col("start").cast("long"), F.lit(0)).alias("start"), F.coalesce(F.col("period").cast("long"), F.lit(0)).alias("period"),
    )
    cut = stored(rows.mapInPandas(opened(core), OPENED))
    far = cut.where("low is not null").select(*KEY, "n", "words", *TILE).repartition(*KEY, "low", "core")
    near = cut.where("low is null").select(*KEY, F.explode("fragments").alias("f"))
    fragments = near.select(*KEY, *[F.col("f")[i].alias(c) for i, c in enumerate(("period", "first", "last"))]).unionByName(
        far.mapInPandas(solve_tiles, FRAGMENTS)
    )
    runs = runs_of(fragments).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    found = cut.where("low is null").select(*KEY, "n", "plain", "words").join(runs, KEY, "left")
    kind = docs.schema["doc_id"].dataType
    return found.withColumn("kept", collapsed("words", "runs")).select(
        F.when(F.col("doc") != "", F.substr("doc", F.lit(2))).cast(kind).alias("doc_id"), F.col("n").alias("n_words"),
        F.coalesce("runs", F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")).alias("runs"), "kept",
        F.coalesce(F.sha2(F.col("kept").cast("binary"), 256), "plain").alias("collapsed_sha256"),
    )


def longest(runs: str) -> Column:
    """The run of greatest length by period, compared exactly; of equal ones the first."""
    nothing = F.lit(None).cast("struct<start:bigint,period:bigint,length:bigint>")

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, nothing, better)
