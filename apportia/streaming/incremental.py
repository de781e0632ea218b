"""Incremental loads: a stored mark moved by slices, or files picked up as they arrive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from apportia.operators import commits, sinks


def next_window(mark: datetime, step: timedelta, limit: datetime) -> tuple[datetime, datetime] | None:
    """Window (mark, mark + step] with second precision, or None when it would pass the limit."""
    last = mark + step
    return None if last > limit else (mark + timedelta(seconds=1), last)


def advance(
    read_mark: Callable[[], datetime], write_mark: Callable[[datetime], None], step: timedelta,
    limit: datetime, load: Callable[[str, str], object],
) -> int:
    """Load window after window; the mark moves only after a window is stored, so a run that
    stops is continued where it was and a repeated window replaces itself."""
    done = 0
    while (w := next_window(read_mark(), step, limit)) is not None:
        load(f"{w[0]:%Y-%m-%d %H:%M:%S}", f"{w[1]:%Y-%m-%d %H:%M:%S}")
        write_mark(w[1])
        done += 1
    return done


def advance_stored(
    store: commits.Tables, name: str, start: datetime, step: timedelta, limit: datetime,
    load: Callable[[str, str, commits.State, dict[str, str]], object],
) -> int:
    """Load window after window from the mark kept with the tables; returns the windows this runner loaded.

    ``load`` gets the window, the state to commit on and the mark to commit with the rows, so rows and mark
    move together. Of runners that take the same window one commits; the others meet a conflict and look again.
    """
    done = 0
    while True:
        state = store.state()
        mark = datetime.fromisoformat(state.marks[name]) if name in state.marks else start
        w = next_window(mark, step, limit)
        if w is None:
            return done
        try:
            load(f"{w[0]:%Y-%m-%d %H:%M:%S}", f"{w[1]:%Y-%m-%d %H:%M:%S}", state, {name: w[1].isoformat()})
            done += 1
        except commits.Conflict:
            continue


def load_arrivals(
    spark: SparkSession, source: str, schema: StructType, target: str, keys: list[str],
    partition_by: list[str], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Upsert the files that arrived since the last run and stop.

    The checkpoint remembers the files already taken. A batch is written by key, so one repeated
    after a failure changes nothing; of several rows with a key in one batch the greatest counts.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rest = [c for c in rows.columns if c not in keys]
        one = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__r")).select(*keys, "__r.*")
        session = batch.sparkSession
        if has_rows(session, target):
            sinks.merge_partitions(session, target, one, keys, partition_by)
        else:
            sinks.replace_partitions(one, target, partition_by)

    stream = spark.readStream.schema(schema).parquet(source)
    query = (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def has_rows(spark: SparkSession, path: str) -> bool:
    from pyspark.sql.utils import AnalysisException

    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
