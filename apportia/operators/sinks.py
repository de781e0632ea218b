"""Writes: alignment, upsert, window and key replacement, surrogate ids, run events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from apportia import schemas
from apportia.session import cut_lineage


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the target in its order and types; missing ones are typed nulls."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def zero_keys_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Zero and the text 'None' stand for a missing key."""
    t = lambda c: F.col(c).cast("string")
    return df.withColumns(
        {c: F.when(t(c).isin("0", "None", "none", ""), None).otherwise(F.col(c)) for c in cols}
    )


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The greatest row per key: the same one on every run, unlike an arbitrary duplicate."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row")).select(*keys, "__row.*").select(*df.columns)


# --- pure forms: the table after the write -------------------------------------------------


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows of the same key, null keys included; the rest is added."""
    right = source.select(*[F.col(k).alias(f"__s_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys])
    return target.join(right, on, "left_anti").unionByName(source, allowMissingColumns=True)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it does not have, the greatest row per key."""
    new = one_per_key(source.join(target.select(*keys), keys, "left_anti"), keys)
    return target.unionByName(new, allowMissingColumns=True)


def replace_where(target: DataFrame, source: DataFrame, condition: Column) -> DataFrame:
    """Drop target rows that meet the condition, then add the source."""
    return target.where(~F.coalesce(condition, F.lit(False))).unionByName(source)


def replace_keys(target: DataFrame, source: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return target.join(keys.select(*on).distinct(), on, "left_anti").unionByName(source)


def replace_window(
    docs: DataFrame, items: DataFrame, new_docs: DataFrame, new_items: DataFrame, inside: Column, on: list[str],
) -> tuple[DataFrame, DataFrame]:
    """(documents, items) after a window is loaded again: its documents go with their items, also if none come."""
    gone = docs.where(inside).select(*on).unionByName(new_docs.select(*on))
    return replace_where(docs, new_docs, inside), replace_keys(items, new_items, gone, on)


def update_columns(
    target: DataFrame, changes: DataFrame, keys: list[str], cols: list[str]
) -> DataFrame:
    """Take the listed columns from ``changes`` where the key is there, nulls included.

    Of several changes to a key the greatest counts.
    """
    right = one_per_key(changes.select(*keys, *cols), keys).select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in cols], F.lit(True).alias("__hit")
    )
    out = target.join(right, keys, "left")
    value = lambda c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
    return out.select(*[value(c) if c in cols else F.col(c) for c in target.columns])


def reset_reason(
    target: DataFrame, reasons: list[int], within: Column | None = None, keys: DataFrame | None = None,
    on: list[str] | None = None, column: str = "reason",
) -> DataFrame:
    """Clear exclusion reasons in a window or for a key list."""
    hit = F.col(column).isin(*reasons)
    if within is not None:
        hit = hit & within
    if keys is None:
        return target.withColumn(column, F.when(~F.coalesce(hit, F.lit(False)), F.col(column)))
    listed = keys.select(*on).distinct().withColumn("__listed", F.lit(True))
    out = target.join(listed, on, "left")
    hit = F.coalesce(hit & F.col("__listed"), F.lit(False))
    return out.withColumn(column, F.when(~hit, F.col(column))).select(*target.columns)


def delete_keys(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return target.join(keys.select(*on).distinct(), on, "left_anti")


def split_participating(df: DataFrame, column: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(participating, excluded) rows; the excluded ones have their own table."""
    return df.where(F.col(column).isNull()), df.where(F.col(column).isNotNull())


def close_versions(
    stored: DataFrame, incoming: DataFrame, keys: list[str], start: str, stop: str
) -> DataFrame:
    """Type-2 table after new versions: merged by key and start, each closed by the next start."""
    from apportia.operators import spans

    merged = insert_new(stored, incoming, [*keys, start])
    nxt = spans.next_row(merged, keys, [start], spans.month_span(start), [start], "__next")
    closed = F.coalesce(F.col(f"__next.{start}") - F.expr("INTERVAL 1 SECOND"), F.col(stop))
    return nxt.withColumn(stop, closed).select(*stored.columns)


# --- surrogate ids --------------------------------------------------------------------------


def assign_ids(
    keys: DataFrame, key_map: DataFrame | None, key: str, bucket: Column | None = None
) -> DataFrame:
    """Key map extended by the keys it lacks: ids continue after the highest one, without gaps.

    Keys are numbered inside buckets and each bucket starts after the ones before it, so nothing
    is sorted in one task. The bucket is a hash of the key; a bucket that rises with the key
    numbers them in key order and must be a number. New keys are stored once.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if key_map is not None:
        fresh = fresh.join(key_map.select(key), key, "left_anti")
    b = F.pmod(F.xxhash64(key), F.lit(4096)) if bucket is None else bucket
    placed = cut_lineage(fresh.withColumn("__bucket", b))
    ranked = placed.withColumn(
        "__rank", F.row_number().over(W.partitionBy("__bucket").orderBy(key)).cast("bigint")
    )
    counts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # Offsets in two levels: ranges of buckets, then buckets within their range. With the ranges of a
    # thousand buckets each, both stay small.
    upto = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("__range", F.floor(F.col("__bucket") / 1024))
    ranges = counts.groupBy("__range").agg(F.sum("__n").alias("__n"))
    ranges = ranges.select("__range", upto(W.partitionBy(F.lit(0)).orderBy("__range")).alias("__start"))
    offsets = (
        counts.withColumn("__base", upto(W.partitionBy("__range").orderBy("__bucket"))).join(ranges, "__range")
        .select("__bucket", (F.col("__base") + F.col("__start")).alias("__base"))
    )
    if key_map is not None:
        top = key_map.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    else:
        top = F.lit(0)
    new = ranked.join(offsets, "__bucket").select(
        key, (F.col("__base") + F.col("__rank") + top).cast("bigint").alias("id")
    )
    return new if key_map is None else key_map.select(key, "id").unionByName(new)


def extend_map(
    key_map: DataFrame | None, keys: DataFrame, cols: list[str], buckets: int, bucket: Column | None = None
) -> DataFrame:
    """Identity map (bucket, cols, id) of composite keys after the keys it lacks are added; null parts equal null.

    Bucket b gives the ids b, b + buckets, b + 2 buckets and so on in key order, after the last it has given, so ids
    need no offset from other buckets, and a bucket without new keys stays as it is. Keys are numbered inside
    ranges of the key order, which grow in number with the keys, and each starts after those before it in
    its bucket, so no task holds a whole bucket. The bucket is a hash of the key, or a number from 0 to buckets - 1.
    """
    b = F.pmod(F.xxhash64(*cols), F.lit(buckets)) if bucket is None else bucket
    fresh = keys.select(*cols).distinct().select(b.cast("int").alias("bucket"), *cols, F.lit(None).cast("bigint").alias("id"))
    both = fresh if key_map is None else key_map.select("bucket", *cols, "id").unionByName(fresh)
    dealt = both.groupBy("bucket", *cols).agg(F.max("id").alias("id"))
    placed = cut_lineage(dealt.repartitionByRange("bucket", *cols).withColumn("__range", F.spark_partition_id()))
    new = placed.where("id is null").drop("id")
    top = placed.groupBy("bucket").agg(F.max("id").alias("__top"))
    before = W.partitionBy("bucket").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    counts = new.groupBy("bucket", "__range").agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.join(top, "bucket").select(
        "bucket", "__range",
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) + F.coalesce(F.floor(F.col("__top") / buckets) + 1, F.lit(0))).alias("__start"),
    )
    nth = F.row_number().over(W.partitionBy("bucket", "__range").orderBy(*cols)).cast("bigint")
    ranked = new.withColumn("__nth", nth).join(F.broadcast(starts), ["bucket", "__range"], "left")
    id_ = (F.col("__start") + F.col("__nth") - 1) * buckets + F.col("bucket")
    held = placed.where("id is not null").select("bucket", *cols, "id")
    return held.unionByName(ranked.select("bucket", *cols, id_.cast("bigint").alias("id")))


def new_buckets(key_map: DataFrame, keys: DataFrame, cols: list[str], buckets: int, bucket: Column | None = None) -> list[int]:
    """Buckets that get new keys; at most ``buckets`` numbers."""
    b = F.pmod(F.xxhash64(*cols), F.lit(buckets)) if bucket is None else bucket
    fresh = delete_null_safe(keys.select(*cols).distinct(), key_map, cols)
    return sorted(r[0] for r in fresh.select(b.cast("int").alias("bucket")).distinct().collect())


def delete_null_safe(rows: DataFrame, keys: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose key, null parts included, is not among the keys."""
    right = keys.select(*[F.col(c).alias(f"__k_{c}") for c in cols])
    return rows.join(right, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in cols]), "left_anti")


# --- stored tables --------------------------------------------------------------------------


def write(
    df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> Observation:
    """Write and count in the same pass; ``Observation.get["rows"]`` is the number written."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return seen


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> Observation:
    """Replace exactly the partitions the frame holds; running it again changes nothing.

    Rows are brought together by partition value; adaptive execution splits large partitions by size.
    """
    return write(df.hint("rebalance", *partition_by), path, "overwrite", partition_by)


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or None where nothing has been stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_rows(
    spark: SparkSession, rows: DataFrame, path: str, partition_by: list[str], touched: Column,
    gone: Column | DataFrame, on: list[str] | None = None,
) -> int:
    """Put rows in the place of those that are gone; returns how many were put in.

    ``gone`` is a condition, or the keys ``on`` whose rows go. Only partitions that meet ``touched``, a
    condition on partition columns, are read and written again; one that is left without rows is deleted.
    """
    new = cut_lineage(rows)
    old = stored_rows(spark, path)
    if old is None:
        write(new.hint("rebalance", *partition_by), path, "overwrite", partition_by)
        return new.count()
    old = old.where(touched)
    had = old.select(*partition_by).distinct().collect()
    kept = old.where(~F.coalesce(gone, F.lit(False))) if isinstance(gone, Column) else old.join(gone, on, "left_anti")
    out = cut_lineage(kept.select(*new.columns).unionByName(new))
    write(out.hint("rebalance", *partition_by), path, "overwrite", partition_by)
    has = {tuple(r) for r in out.select(*partition_by).distinct().collect()}
    for row in had:
        if tuple(row) not in has:
            remove_partition(spark, path, row.asDict())
    return new.count()


def remove_partition(spark: SparkSession, path: str, values: dict[str, object]) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{k}={v}" for k, v in values.items()]]))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_partitions(spark: SparkSession, path: str, out: str, keep: Column, partition_by: list[str]) -> None:
    """Copy of a table without the partitions that fail ``keep``."""
    write(spark.read.parquet(path).where(keep), out, "overwrite", partition_by)


def merge_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str]
) -> Observation:
    """Upsert into a partitioned Parquet table, rewriting only the partitions the source touches.

    The partition columns must belong to the key, so a row never leaves its partition.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    stored = spark.read.parquet(path)
    touched = source.select(*partition_by).distinct()
    old = stored.join(touched, partition_by, "left_semi")
    return replace_partitions(upsert(old, source, keys).select(*stored.columns), path, partition_by)


def merge_into_table(source: DataFrame, table: str, keys: list[str]) -> None:
    """Upsert into a catalog table whose format has row-level operations."""
    on = reduce(
        lambda a, b: a & b, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"source.{k}")) for k in keys]
    )
    (
        source.alias("source").mergeInto(table, on)
        .whenMatched().updateAll().whenNotMatched().insertAll().merge()
    )


def export_csv(df: DataFrame, path: str, sep: str = "|") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def verify_written(spark: SparkSession, path: str, run_id: int, expected: int) -> None:
    """Rows of the run found in the table must equal the rows written."""
    found = spark.read.parquet(path).where(F.col("run_id") == run_id).count()
    if found != expected:
        raise RuntimeError(f"run {run_id}: {expected} rows written, {found} found")


# --- run events -----------------------------------------------------------------------------


def run_event(
    spark: SparkSession, path: str, run_id: int, job: str, status: str, note: str = "",
    counts: dict[str, int] | None = None,
) -> None:
    """Append the state of a run, with its counters, to the run-event table."""
    base = spark.range(1).select(
        F.lit(run_id).cast("bigint").alias("run_id"), F.lit(job).alias("job"),
        F.current_timestamp().alias("at"), F.lit(status).alias("status"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("counter"), F.lit(v).cast("bigint").alias("amount"))
                    for n, v in (counts or {"rows": 0}).items()
                ]
            )
        ).alias("c"),
        F.lit(note).alias("note"),
    )
    align(base.select("*", "c.counter", "c.amount"), schemas.RUN_EVENT).write.mode("append").parquet(path)


def run_states(events: DataFrame) -> DataFrame:
    """Current state, start, end and added-up counters of each run."""
    last = events.groupBy("run_id").agg(
        F.max_by("job", "at").alias("job"),
        F.min("at").alias("started_at"),
        F.max_by("status", F.struct("at", "status")).alias("status"),
        F.max("at").alias("changed_at"),
        F.sum("amount").alias("amount"),
    )
    return last


def audited(spark: SparkSession, path: str, run_id: int, job: str, work):
    """Run ``work()``, which returns counters, between a start and an end event."""
    run_event(spark, path, run_id, job, "started")
    try:
        counts = work()
    except Exception as e:
        run_event(spark, path, run_id, job, "failed", str(e))
        raise
    run_event(spark, path, run_id, job, "succeeded", counts=counts)
    return counts
