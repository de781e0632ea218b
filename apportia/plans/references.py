"""References of the rules in one place, normalised once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia.functions import codes, params
from apportia.operators import joins, rollups
from apportia.sources import tables

SWITCHES = {
    "USE_OP_CODES": True, "USE_PRODUCTS": True, "USE_EVENTS": True, "USE_MUNICIPALITIES": True,
    "DROP_OTHER_OP_CODES": False, "DROP_OTHER_PRODUCTS": False, "DROP_EXCLUDED": False,
}


@dataclass(frozen=True)
class References:
    op_codes: DataFrame  # code, participates
    products: DataFrame  # code, participates
    events: DataFrame  # collapsed, by access_key
    municipalities: DataFrame
    switches: dict[str, object]


def normalise_codes(ref: DataFrame, to_code, width: int) -> DataFrame:
    """(code, participates): one row per code of the right width, a known flag first."""
    rows = ref.select(to_code("code").alias("code"), codes.flag("participates").alias("participates"))
    return joins.prefer_known(rows.where(F.length("code") == width), "code", "participates")


def load(spark: SparkSession, catalog: tables.Catalog) -> References:
    bundle = tables.read_references(spark, catalog)
    events = rollups.classified_events(bundle["events"], "access_key", "kind", "at")
    return References(
        normalise_codes(bundle["op_codes"], codes.op_code, 4),
        normalise_codes(bundle["products"], codes.product_code, 8),
        rollups.collapse_events(events),
        bundle["municipalities"],
        params.switches(bundle["params"], SWITCHES),
    )
