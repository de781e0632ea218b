"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging of the lists."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_ROWS, SHARD_ROWS, FAN_IN = 4096, 32768, 16


def whole_numbers(col: str, scale: float) -> Column:
    """floor(scale * x) of each component, null where a component is null or not finite."""
    fine = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of a matrix; shorter vectors end in zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; in floating point where that is exact."""
    width = min(q.shape[1], c.shape[1])
    q, c = q[:, :width], c[:, :width]
    if width == 0:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * width
    if most < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def best_of_cell(k: int, tile: int = 256):
    """Function of (queries, candidates) of one cell: the k best candidates of each of its queries."""

    def best(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(queries) and len(candidates):
            candidates = candidates.sort_values("cand", kind="stable")
            ids, c = candidates["cand"].to_numpy(np.int64), matrix(candidates["row"])
            all_ids, all_q = queries["id"].to_numpy(np.int64), matrix(queries["vector"])
            for start in range(0, len(all_ids), tile):
                q_ids = all_ids[start : start + tile]
                scores = products(all_q[start : start + tile], c)
                for qid, row in zip(q_ids, scores):
                    other = np.flatnonzero(ids != qid)
                    s = row[other]
                    if len(s) > k:
                        kth = np.partition(s, len(s) - k)[len(s) - k]
                        above = np.flatnonzero(s > kth)
                        pick = np.concatenate([above, np.flatnonzero(s == kth)[: k - len(above)]])
                    else:
                        pick = np.arange(len(s))
                    out.append((np.full(len(pick), qid), s[pick], ids[other[pick]]))
        parts = [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, dtype=np.int64)] * 3
        shard = np.full(len(parts[0]), key[1], dtype=np.int64)
        return pd.DataFrame({"query_id": parts[0], "shard": shard, "score": parts[1], "vec_id": parts[2]})

    return best


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, query_rows: int = QUERY_ROWS,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k candidates of highest integer inner product for each query: query_id, rank, vec_id, score.

    Both frames have ``id`` and ``vector`` (integers). A query does not meet candidates of its own id;
    ties go to the smaller id. Rows without id or vector take no part, a query id given more than once
    counts with its least vector, repeated candidate rows are each ranked, shorter vectors count as if
    they ended in zeros, and a query without candidates has no rows.

    Queries are dealt into groups and candidates into shards of bounded size; each pair of them is one
    cell, multiplied tile by tile. A cell leaves k rows for a query; lists are merged FAN_IN at a time.
    """
    queries = queries.where("id is not null and vector is not null").groupBy("id").agg(F.min("vector").alias("vector"))
    candidates = candidates.where("id is not null and vector is not null").select("id", "vector")
    groups = max(1, math.ceil(queries.count() / query_rows))
    shards = max(1, math.ceil(candidates.count() / shard_rows))
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = queries.select("id", "vector", deal(groups, 1).alias("g"), every(shards).alias("s"))
    c = candidates.select(F.col("id").alias("cand"), F.col("vector").alias("row"), every(groups).alias("cg"), deal(shards, 2).alias("cs"))
    lists = (
        q.groupBy("g", "s").cogroup(c.groupBy("cg", "cs"))
        .applyInPandas(best_of_cell(k), "query_id long, shard long, score long, vec_id long")
    )
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id"))), 1, k)
    lists = lists.groupBy("query_id", F.floor(F.col("shard") / FAN_IN).alias("shard")).agg(best.alias("best"))
    left = math.ceil(shards / FAN_IN)
    while left > 1:
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.groupBy("query_id", F.floor(F.col("shard") / FAN_IN).alias("shard")).agg(merged.alias("best"))
        left = math.ceil(left / FAN_IN)
    found = lists.select("query_id", F.posexplode("best").alias("at", "hit"))
    return found.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.neg")).alias("score"),
    )
