"""Session helpers: building a session, and storing what several steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build(app: str = "apportia", master: str | None = None) -> SparkSession:
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    return (b.master(master) if master else b).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder spark.checkpoint.dir names; where it is unset, one of this machine, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="apportia-tables-")


def fits_parquet(schema: T.StructType) -> bool:
    """Whether a Parquet table can hold the columns: no void or calendar interval, names that differ in more than case."""
    def holds(t: T.DataType) -> bool:
        if isinstance(t, T.StructType):
            names = {f.name.lower() for f in t.fields}
            return 0 < len(names) == len(t.fields) and all(holds(f.dataType) for f in t.fields)
        if isinstance(t, T.ArrayType):
            return holds(t.elementType)
        if isinstance(t, T.MapType):
            return holds(t.keyType) and holds(t.valueType)
        return not isinstance(t, (T.NullType, T.CalendarIntervalType, T.UserDefinedType))

    return holds(schema)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store in the shared folder the session names, as a Parquet table: readers take only the columns they need.

    A frame that Parquet cannot hold is checkpointed. Where the session names no folder, one of this machine
    serves on a local master; on a cluster that is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="apportia-checkpoint-"))
    if not fits_parquet(df.schema):
        return df.checkpoint()
    path = f"{folder or sc.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
