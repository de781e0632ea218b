"""Reference tables loaded from delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import codes
from apportia.operators import sinks


def op_codes(stored: DataFrame, file: DataFrame, start: str, doc_type: int) -> DataFrame:
    """Participating operation codes of a document type, valid from a day on."""
    rows = file.select(
        codes.op_code("code").alias("code"), F.lit(start).cast("date").alias("start"),
        F.lit(None).cast("date").alias("stop"), F.lit(doc_type).alias("doc_type"),
    )
    return sinks.insert_new(stored, rows.where(F.length("code") == 4), ["code", "start", "doc_type"])


def drop_op_codes(stored: DataFrame, year: int, doc_type: int) -> DataFrame:
    hit = (F.year("start") == year) & (F.col("doc_type") == doc_type)
    return stored.where(~F.coalesce(hit, F.lit(False)))


def coded(file: DataFrame, known: DataFrame, code: str, width: int, start: str) -> DataFrame:
    """File codes, filled to their width, with the id of the code table; unknown codes go.

    Rural products and rural activities are loaded this way and replace their table.
    """
    digits = codes.digits_only(code)
    rows = file.select(F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits).alias("code"))
    return rows.distinct().join(known.select("code", "id"), "code").withColumn("start", F.lit(start).cast("date"))


def activity_branches(file: DataFrame, known: DataFrame) -> DataFrame:
    """Branch of each activity code; an unknown code keeps a null id."""
    rows = file.select(F.lpad(codes.digits_only("activity"), 7, "0").alias("code"), "branch")
    return rows.join(known.select("code", "id"), "code", "left").select("id", "branch")


def municipality_map(file: DataFrame, munis: DataFrame) -> DataFrame:
    """Revenue-service municipality numbers mapped to ours."""
    rows = file.select(codes.whole("revenue_code").alias("revenue_muni"), codes.whole("muni").alias("muni"))
    return rows.join(munis.select(F.col("muni").cast("bigint").alias("muni")), "muni").select("revenue_muni", "muni")


def exclusion_reasons(spark) -> DataFrame:
    """Reason table with the level each reason applies to."""
    pairs = [F.struct(F.lit(k).alias("reason"), F.lit(v).alias("text")) for k, v in K.REASON_TEXT.items()]
    rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*pairs)))
    return rows.withColumn("level", F.when(F.col("reason") < K.CANCELLED, "item").otherwise("document"))


def parameters(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Parameter rows updated and added by name."""
    return sinks.upsert(stored, changes, ["name"])
