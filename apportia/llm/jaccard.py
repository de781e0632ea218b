"""N-gram Jaccard join: MinHash LSH forest, then exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import chunks, lean, stored
from apportia.llm.components import components
from apportia.llm.toxicity import TOKENS, Words

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.995
TREES, DEPTH, BLOCK, CHARS_AT_ONCE = 16, 8, 128, 1_000_000
#: How far below the similarity an estimate from all signature places may lie: over four standard deviations.
SLACK = 0.15
ODD = np.uint64(0x9E3779B97F4A7C15)


def prefix_depth(similarity: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the prefix that must match until pairs of that similarity meet in some tree often enough."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles_of(words: list[int]) -> np.ndarray:
    """Sorted digests of the runs of five words."""
    if len(words) < SHINGLE:
        return np.empty(0, dtype=np.uint64)
    codes = np.array(words, dtype=np.uint64)
    n = len(codes) - SHINGLE + 1
    value = np.zeros(n, dtype=np.uint64)
    for at in range(SHINGLE):
        value = (value ^ codes[at : at + n]) * ODD
        value ^= value >> np.uint64(29)
    return np.unique(value)


def multipliers() -> np.ndarray:
    return np.random.default_rng(5).integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Least 32-bit hash of the shingles for each multiplier."""
    out = np.full(len(by), 2**64 - 1, dtype=np.uint64)
    for s in range(0, len(shingles), 4096):
        part = shingles[None, s : s + 4096] * by[:, None]
        out = np.minimum(out, part.min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def set_key(doc: int, text: str, found: list[str], shingles: np.ndarray) -> int:
    """Digest of a text's shingle set; of its words, of the text or of the id where it has fewer."""
    if len(shingles):
        body = b"s" + shingles.tobytes()
    elif found:
        body = b"w" + " ".join(found).encode("utf-8", "surrogatepass")
    elif text.strip():
        body = b"t" + text.encode("utf-8", "surrogatepass")
    else:
        body = b"d%d" % doc
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "big", signed=True)


def sketch(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, the key of its shingle set, and its signature (null below five words)."""
    words, by = Words(), multipliers()
    for rows in batches:
        texts, ids = rows["text"].fillna("").tolist(), rows["doc_id"].tolist()
        for start, end in chunks(texts, CHARS_AT_ONCE):
            out = []
            for doc, text in zip(ids[start:end], texts[start:end]):
                found = TOKENS.findall(text.lower())
                shingles = shingles_of([words[w] for w in found])
                out.append((doc, set_key(doc, text, found, shingles), signature(shingles, by) if len(shingles) else None))
            yield pd.DataFrame(out, columns=["doc_id", "node", "sig"])


def shingled(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = Words()
    for rows in batches:
        texts, ids = rows["text"].fillna("").tolist(), rows["doc_id"].tolist()
        for start, end in chunks(texts, CHARS_AT_ONCE):
            out = []
            for doc, text in zip(ids[start:end], texts[start:end]):
                found = TOKENS.findall(text.lower())
                shingles = shingles_of([words[w] for w in found])
                out.append((set_key(doc, text, found, shingles), shingles.view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "body"])


def roots_of(n: int, pairs: Iterable[tuple[int, int]]) -> np.ndarray:
    """Least member of each one's group."""
    up = list(range(n))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in pairs:
        a, b = root(i), root(j)
        up[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)], dtype=np.int64)


def alike(bodies: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs whose signatures agree in at least so many places."""
    sigs = np.stack(bodies)
    same = np.zeros((len(left), len(right)), dtype=np.int32)
    for at in range(sigs.shape[1]):
        same += sigs[left, at][:, None] == sigs[right, at][None, :]
    i, j = np.nonzero(same >= least * sigs.shape[1])
    return [(a, b) for a, b in zip(left[i].tolist(), right[j].tolist()) if a != b]


def similar(bodies: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of exact Jaccard similarity, each once."""
    sets = [set(b.tolist()) for b in bodies]
    sizes = [len(s) for s in sets]
    out = []
    same = left is right
    for i in left.tolist():
        for j in right.tolist():
            if same and j <= i or min(sizes[i], sizes[j]) < least * max(sizes[i], sizes[j]):
                continue
            both = len(sets[i] & sets[j])
            if both >= least * (sizes[i] + sizes[j] - both) - 1e-9:
                out.append((i, j))
    return out


def linked(find: Callable, least: float):
    """Rows (node, root, links) of one cell: the pairs of its two blocks, as links counted and a root for each node."""

    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for lo, hi, members in zip(rows["lo"], rows["hi"], rows["members"]):
                members = sorted(members, key=lambda m: m["node"])
                nodes = np.array([m["node"] for m in members], dtype=np.int64)
                block = np.array([m["block"] for m in members])
                left = np.flatnonzero(block == lo)
                pairs = find([np.asarray(m["body"]) for m in members], left, left if lo == hi else np.flatnonzero(block == hi), least)
                if pairs:
                    count = np.bincount(np.array(pairs).ravel(), minlength=len(nodes))
                    some = np.flatnonzero(count)
                    yield pd.DataFrame({"node": nodes[some], "root": nodes[roots_of(len(nodes), pairs)[some]], "links": count[some]})

    return rows_of


def cells(members: DataFrame, group: str, block: int = BLOCK) -> DataFrame:
    """Members of a group (group, node, n, body) as cells of two blocks of about ``block`` nodes each."""
    parts = F.ceil(F.col("n") / block).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return dealt.groupBy(group, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).agg(
        F.collect_list(F.struct("node", "block", "body")).alias("members")
    )


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_copies, n_links.

    Documents with the same set of five-word runs are copies and are compared as one. Two such sets are
    linked if their Jaccard similarity is at least ``similarity``; n_links counts a document's links to other
    sets, n_copies the documents with its own set. A class is what links connect; its id is its least doc_id.

    Signatures stand in TREES prefix tries. Sets that share a prefix of the depth found for ``recall`` in
    some trie, and whose whole signatures agree nearly as much as asked, are joined into provisional
    groups; within these all pairs are verified on the full sets. Groups of any size are worked in cells of
    two blocks, which give counts and one root per member, never pairs.

    Words are runs of letters and digits in lower case. Texts of fewer than five words are copies if their
    words are the same; texts without words if they are the same; null and blank texts are copies of none.
    Rows without doc_id have no row here; repeated rows count as copies, each with its row. An empty table
    gives no rows; other columns are not read. Counts by key are stored before they are joined, so that
    Spark can split the join where one key is very common.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    sketches = stored(docs.mapInPandas(lean(sketch), "doc_id long, node long, sig array<int>"))
    copies = stored(sketches.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), F.first("sig").alias("sig")
    ))
    sets = copies.where("sig is not null").select("node", "sig")

    depth = prefix_depth(similarity, recall)
    tree = F.explode(F.array(*[
        F.xxhash64(F.lit(t), F.slice("sig", t * DEPTH + 1, depth)) for t in range(TREES)
    ]))
    tries = stored(sets.select("node", tree.alias("prefix")))
    met = stored(tries.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1"))
    members = tries.join(met, "prefix").join(sets.withColumnRenamed("sig", "body"), "node")
    near = cells(members, "prefix").mapInPandas(lean(linked(alike, similarity - SLACK)), "node long, root long, links long")
    groups = stored(components(near.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    sizes = stored(groups.groupBy("class").agg(F.count("*").alias("n")))
    inside = stored(groups.join(sizes, "class").join(copies.select("node", "first_id"), "node"))
    texts = docs.join(inside.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi")
    bodies = texts.mapInPandas(lean(shingled), "node long, body array<long>")
    links = stored(cells(inside.join(bodies, "node").dropDuplicates(["node"]), "class").mapInPandas(
        lean(linked(similar, similarity)), "node long, root long, links long"
    ))
    final = stored(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    least = stored(
        final.join(copies.select("node", "first_id"), "node").groupBy("class").agg(F.min("first_id").alias("class_id"))
    )
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    known = stored(
        copies.join(final.join(least, "class").select("node", "class_id"), "node", "left").join(counts, "node", "left")
        .select("node", F.coalesce("class_id", "first_id").alias("class_id"), "n_copies",
                F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    )
    return sketches.select("doc_id", "node").join(known, "node").select("doc_id", "class_id", "n_copies", "n_links")
