"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; where it is unset, one of this machine, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return LOCAL.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="apportia-shared-"))


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is computed once, and its lineage ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean(work: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``work`` over batches, after which the worker gives back what it holds free: workers serve stage after stage."""

    @functools.wraps(work)
    def run(batches: Iterable) -> Iterator:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def row_digest(*cols: str | Column) -> Column:
    """Order-giving 64-bit digest of columns."""
    return F.xxhash64(*cols)


def chunks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters together; one longer text is a range of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def remainder_of_id(col: str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % parts


