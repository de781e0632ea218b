"""Removal of repeated byte strings by refining buckets of sampled suffixes.

Every string of ``length`` bytes holds one anchor: the q-gram of least digest among those that start in it,
the first of several. Equal strings have their anchor at the same place, so only anchors are compared. The
q-grams give the first buckets. A bucket with several anchors is refined by the identifiers of the bytes
at further offsets before and behind the anchor, for all strings at once, then for ever smaller blocks of
strings, until a block is known to be repeated whole or to be unique; what one round has settled, the next
takes over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import stored

LENGTH, GRAM = 400, 32
SPLITS = (48, 6, 1)
SEGMENT = 2**22
ODD, MORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SPAN = "array<struct<start: int, stop: int>>"


def digest(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "big", signed=True)


def grams(body: bytes) -> np.ndarray:
    """64-bit digest of the GRAM bytes from each offset."""
    n = len(body) - GRAM + 1
    words = np.empty(len(body) - 7, dtype=np.uint64)
    for at in range(8):
        part = np.frombuffer(body, dtype="<u8", offset=at, count=(len(body) - at) // 8)
        words[at::8] = part
    value = words[:n] * ODD
    for at in range(8, GRAM, 8):
        value ^= value >> np.uint64(32)
        value += words[at : at + n]
        value *= MORE
    value ^= value >> np.uint64(29)
    value *= ODD
    return value ^ (value >> np.uint64(32))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least value in each window."""
    n, held = len(values) - width + 1, 1
    while held * 2 <= width:
        values = np.minimum(values[:-held], values[held:])
        held *= 2
    rest = width - held
    return np.minimum(values[:n], values[rest : rest + n]) if rest else values[:n]


def anchors(body: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(q-gram digest, anchor, least, most): the strings that start ``least`` to ``most`` bytes before the anchor have it."""
    width = length - GRAM + 1
    for first in range(0, len(body) - length + 1, SEGMENT):
        part = body[first : first + SEGMENT + length - 1]
        value = grams(part)
        place = np.arange(len(value), dtype=np.uint64)
        found = least_of((value & np.uint64(0xFFFFFFFFFF000000)) | place, width) & np.uint64(0xFFFFFF)
        change = np.flatnonzero(np.diff(found)) + 1
        starts = np.concatenate([[0], change])
        stops = np.concatenate([change, [len(found)]]) - 1
        at = found[starts].astype(np.int64)
        for g, a, p, r in zip(value[at].view(np.int64).tolist(), at.tolist(), starts.tolist(), stops.tolist()):
            yield g, first + a, a - r, a - p


def anchored(length: int):
    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for row, text in zip(rows["row"], rows["text"]):
                body = (text or "").encode("utf-8", "surrogatepass")
                for g, a, low, high in anchors(body, length):
                    out.append((g, row, a, low, high, digest(body[a - high : a - low + length])))
                if len(out) > 200_000:
                    yield pd.DataFrame(out, columns=["gram", "row", "at", "low", "high", "hull"])
                    out = []
            yield pd.DataFrame(out, columns=["gram", "row", "at", "low", "high", "hull"])

    return rows_of


def contexts(length: int):
    """The bytes of all strings of each anchor that is still open."""

    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for row, text, open_ in zip(rows["row"], rows["text"], rows["open"]):
                body = (text or "").encode("utf-8", "surrogatepass")
                out += [
                    (m["gram"], row, m["at"], m["low"], m["high"], body[m["at"] - m["high"] : m["at"] - m["low"] + length])
                    for m in open_
                ]
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["gram", "row", "at", "low", "high", "body"])
                    out = []
            yield pd.DataFrame(out, columns=["gram", "row", "at", "low", "high", "body"])

    return rows_of


BLOCK_COLUMNS = ["gram", "row", "at", "block", "low", "high", "core", "hull"]


def split_blocks(length: int, parent: int, size: int):
    """Blocks of ``size`` strings in those of ``parent`` strings that are open.

    core: what all strings of the block share, hull: all that they cover. Blocks are counted from the anchor,
    so equal strings are in blocks of the same number; a hull is only compared with one of the same strings.
    """

    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for gram, row, at, low, high, body, open_ in zip(
                rows["gram"], rows["row"], rows["at"], rows["low"], rows["high"], rows["body"], rows["open"]
            ):
                for whole in open_:
                    for block in range(whole * parent // size, -(-(whole + 1) * parent // size)):
                        a, b = max(low, block * size), min(high, block * size + size - 1)
                        if a <= b:
                            core = body[high - block * size : high - (block * size + size - 1) + length]
                            out.append((gram, row, at, block, a, b, digest(core), digest(body[high - b : high - a + length])))
                if len(out) > 100_000:
                    yield pd.DataFrame(out, columns=BLOCK_COLUMNS)
                    out = []
            yield pd.DataFrame(out, columns=BLOCK_COLUMNS)

    return rows_of


def settled(blocks: DataFrame) -> DataFrame:
    """Blocks whose core is not unique, with ``done`` (repeated whole) and ``open`` (to be split further).

    Of blocks that are the same whole, one goes on where others share only its core. Counts are stored
    before they are joined, so that Spark can split the join where one string is very common.
    """
    same = ["gram", "block", "low", "high", "hull"]
    cores = stored(blocks.groupBy("gram", "block", "core").agg(F.count("*").alias("n_core")).where("n_core > 1"))
    shared = stored(blocks.join(cores, ["gram", "block", "core"]).drop("core"))
    hulls = stored(shared.groupBy(*same).agg(
        F.count("*").alias("n_hull"), F.min(F.struct("row", "at")).alias("first")
    ).where("n_hull > 1"))
    first = (F.col("first.row") == F.col("row")) & (F.col("first.at") == F.col("at"))
    return (
        shared.join(hulls, same, "left")
        .withColumn("done", F.col("n_hull").isNotNull())
        .withColumn("open", F.when(F.col("done"), (F.col("n_core") > F.col("n_hull")) & first).otherwise(True))
        .select("gram", "row", "at", "block", "low", "high", "done", "open")
    )


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte spans to remove: row, spans. docs: row (a digest of id and text), text."""
    known = stored(docs.mapInPandas(anchored(length), "gram long, row long, at int, low int, high int, hull long"))
    state = stored(settled(known.withColumn("block", F.lit(0)).withColumn("core", F.lit(0).cast("long"))))
    covered = [state]
    waiting = state.where("open").groupBy("row").agg(F.collect_set(F.struct("gram", "at", "low", "high")).alias("open"))
    held = stored(docs.join(waiting, "row").dropDuplicates(["row"]).mapInPandas(
        contexts(length), "gram long, row long, at int, low int, high int, body binary"
    ))
    parent = length
    for size in SPLITS:
        todo = state.where("open").groupBy("row", "at").agg(F.collect_set("block").alias("open"))
        blocks = stored(held.join(todo, ["row", "at"]).mapInPandas(
            split_blocks(length, parent, size),
            "gram long, row long, at int, block int, low int, high int, core long, hull long",
        ))
        state = stored(settled(blocks))
        covered.append(state)
        parent = size
    spans = None
    for part in covered:
        one = part.where("done").select(
            "row", F.struct((F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("stop")).alias("span")
        )
        spans = one if spans is None else spans.unionByName(one)
    return spans.groupBy("row").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def merged(spans: str) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    last = lambda acc: F.element_at(acc, -1)
    return F.aggregate(
        spans, F.array().cast(SPAN),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (last(acc)["stop"] >= s["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["stop"], s["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row of docs as ``row``, with spans (removed, as bytes), n_bytes, n_removed and kept (bytes).

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else in the
    table, overlaps and the same document included. Texts are compared as UTF-8 bytes; null counts as
    empty. A repeated row repeats its strings, so a long enough text of it goes whole. Texts shorter than
    ``length`` stay whole; an empty table gives no rows; other columns, whatever their names, stay in ``row``.
    """
    row = F.xxhash64("doc_id", "text").alias("row")
    spans = stored(repeated(docs.select(row, "text"), length).select("row", merged("spans").alias("spans")))
    packed = docs.select(row.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = packed.join(spans.withColumnRenamed("row", "key"), "key", "left").select(
        "row", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"),
        F.coalesce(F.col("row.text").cast("binary"), F.lit(b"")).alias("body"),
    )
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at("spans", i)["stop"])
    end = lambda i: F.when(i == F.size("spans"), F.octet_length("body")).otherwise(F.element_at("spans", i + 1)["start"])
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")), lambda i: F.hex(F.substring(F.col("body"), begin(i) + 1, end(i) - begin(i)))
    )
    return joined.select(
        "row", "spans", F.octet_length("body").cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_removed"),
        F.when(F.size("spans") == 0, F.col("body")).otherwise(F.unhex(F.array_join(pieces, ""))).alias("kept"),
    )


def brute_spans(texts: list[str | None], length: int) -> list[list[tuple[int, int]]]:
    """Removed spans of each text, every string listed; for tests on a few texts."""
    bodies = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in bodies:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in bodies:
        spans: list[tuple[int, int]] = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and spans[-1][1] >= i:
                    spans[-1] = (spans[-1][0], i + length)
                else:
                    spans.append((i, i + length))
        out.append(spans)
    return out
