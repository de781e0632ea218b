"""Simplified-regime options and declarations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.operators import rollups, sinks
from apportia.sources import extracts

OPTION_KEYS = ["base", "register", "option_no", "start"]


def load_options(
    stored: DataFrame, simplified: DataFrame, micro: DataFrame, registrations: DataFrame, first: int, last: int
) -> DataFrame:
    """Option table after a load: new periods are added, known ones updated."""
    fresh = extracts.option_periods(simplified, micro, registrations, first, last)
    return sinks.upsert(stored, sinks.one_per_key(fresh, OPTION_KEYS), OPTION_KEYS)


def load_declarations(
    rows: DataFrame, first: int, last: int, munis: DataFrame, registrations: DataFrame
) -> DataFrame:
    """Declared revenue per declaration and municipality, with its counted share as value added."""
    total = rollups.declarations(rows, first, last, other=["tax_no", "revenue_muni"])
    placed = total.join(munis.select("revenue_muni", "muni"), "revenue_muni", "left")
    full = F.lpad(F.col("tax_no").cast("string"), 14, "0")
    out = placed.withColumn("full_tax_no", full).join(
        registrations.select(F.col("tax_no").alias("full_tax_no"), "reg"), "full_tax_no", "left"
    )
    return out.select(
        "declaration", "period", "full_tax_no", "reg", "muni", "total", "counted",
        F.lit(K.SIMPLIFIED).alias("doc_type"),
    )
