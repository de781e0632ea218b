"""Storing settled documents and items with their counts checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia.operators import commits, sinks
from apportia.plans import rules as chain
from apportia.session import cut_lineage

PARTITIONS = ["doc_type", "period"]


def documents(spark: SparkSession, docs: DataFrame, path: str, run_id: int, doc_type: int | None = None) -> int:
    """Replace the periods of the frame and compare the rows written with the rows found."""
    out = chain.project_documents(sinks.zero_keys_to_null(docs, ["entry_reg", "exit_reg"]), doc_type, run_id)
    rows = sinks.replace_partitions(out, path, PARTITIONS).get["rows"]
    sinks.verify_written(spark, path, run_id, rows)
    return rows


def items(spark: SparkSession, rows: DataFrame, docs: DataFrame, path: str, run_id: int, doc_type: int) -> int:
    """Items in the period of their document."""
    placed = chain.project_items(rows, doc_type, run_id).join(docs.select("access_key", "period").distinct(), "access_key")
    written = sinks.replace_partitions(placed, path, PARTITIONS).get["rows"]
    sinks.verify_written(spark, path, run_id, written)
    return written


def excluded(docs: DataFrame, path: str) -> int:
    """Documents or items that do not participate, in a table of their own."""
    gone = sinks.split_participating(docs)[1]
    return sinks.replace_partitions(gone, path, PARTITIONS).get["rows"]


def clear(spark: SparkSession, path: str, out: str, doc_type: int, periods: tuple[int, int] | None = None) -> None:
    """Copy of a stored table without a document type, or without its given periods."""
    gone = F.col("doc_type") == doc_type
    if periods:
        gone = gone & F.col("period").between(*periods)
    sinks.clear_partitions(spark, path, out, ~gone, PARTITIONS)


def extend_identity_map(
    tables: commits.Tables, name: str, keys: DataFrame, cols: list[str], buckets: int, bucket: Column | None = None
) -> list[int]:
    """Add new composite keys to a stored map, partitioned by bucket; returns the buckets written again.

    Other buckets are read for their keys only, and their files stay.
    """
    state = tables.state()
    held = tables.read(name, state)
    if held is None:
        rows, touched = sinks.extend_map(None, keys, cols, buckets, bucket), list(range(buckets))
    else:
        touched = sinks.new_buckets(held, keys, cols, buckets, bucket)
        here = (F.pmod(F.xxhash64(*cols), F.lit(buckets)) if bucket is None else bucket).isin(touched)
        old = tables.read(name, state, lambda values: values[0] in touched)
        rows = sinks.extend_map(old, keys.where(here), cols, buckets, bucket)
    if touched:
        rows = cut_lineage(rows)
        tables.commit(state, {name: commits.Change(rows)})
    return touched
