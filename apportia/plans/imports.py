"""Validated imports of external value-added and index files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia import schemas
from apportia.functions import codes
from apportia.operators import sinks

VALUE_ADDED_COLUMNS = (
    "ano", "referencia", "tipo_documento", "tipo_apropriacao", "valor_adicionado", "codigo_municipio",
    "num_inscricao",
)
INDEX_COLUMNS = ("ano", "etapa_indice", "tipo_indice", "indice_participacao", "codigo_municipio")


class ImportRejected(ValueError):
    """Raised with the failed checks and the number of rows that fail each."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(", ".join(f"{n}: {c}" for n, c in failures.items()))
        self.failures = failures


def require_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    df = df.toDF(*[c.strip() for c in df.columns])
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ImportRejected({f"missing column {n}": 1 for n in missing})
    return df


def typed_value_added(raw: DataFrame, munis: DataFrame) -> DataFrame:
    """File rows with typed values and the municipality each district code belongs to."""
    df = require_columns(raw, VALUE_ADDED_COLUMNS)
    t = df.select(
        codes.whole("ano").alias("year"), codes.whole("referencia").alias("period"),
        codes.whole("tipo_documento").alias("doc_type"), F.trim("tipo_apropriacao").alias("direction"),
        F.col("valor_adicionado").alias("raw_value"),
        codes.money("valor_adicionado", "thousands").alias("value_added"),
        codes.whole("codigo_municipio").alias("file_muni"),
        F.coalesce(codes.whole("num_inscricao"), F.lit(0)).alias("reg"),
        (codes.blank_to_null("num_inscricao").isNotNull() & codes.whole("num_inscricao").isNull()).alias("bad_reg"),
    )
    return place(t, munis)


def place(df: DataFrame, munis: DataFrame) -> DataFrame:
    m = munis.select(
        F.col("muni").cast("bigint").alias("file_muni"), F.coalesce("parent", "muni").alias("muni"), "state"
    )
    return df.join(m, "file_muni", "left")


def value_added_checks(
    df: DataFrame, year: int, periods: tuple[int, int], doc_type: int, home: str = K.HOME_STATE
) -> DataFrame:
    """Rows failing each check, counted in one pass."""
    bad = {
        "empty_file": None,
        "other_year": F.coalesce(F.col("year") != year, F.lit(True)),
        "other_period": ~F.coalesce(F.col("period").between(*periods), F.lit(False)),
        "other_type": F.coalesce(F.col("doc_type") != doc_type, F.lit(True)),
        "bad_direction": ~F.coalesce(F.col("direction").isin("E", "S"), F.lit(False)),
        "no_value": codes.blank_to_null("raw_value").isNull(),
        "bad_value": codes.blank_to_null("raw_value").isNotNull() & F.col("value_added").isNull(),
        "no_muni": F.col("file_muni").isNull(),
        "bad_reg": F.col("bad_reg"),
        "outside_state": F.coalesce(F.col("state") != home, F.lit(True)),
    }
    return count_failures(df, bad)


def count_failures(df: DataFrame, bad: dict) -> DataFrame:
    return df.agg(
        *[
            (F.when(F.count(F.lit(1)) == 0, 1).otherwise(0) if c is None else F.count_if(c)).cast("bigint").alias(n)
            for n, c in bad.items()
        ]
    )


def demand(checks: DataFrame) -> None:
    failures = {n: c for n, c in checks.first().asDict().items() if c}
    if failures:
        raise ImportRejected(failures)


def import_value_added(
    raw: DataFrame, munis: DataFrame, year: int, periods: tuple[int, int], doc_type: int, run_id: int,
    home: str = K.HOME_STATE,
) -> DataFrame:
    """Rows ready to store, or ``ImportRejected`` when any check fails."""
    if doc_type not in K.DOCUMENT_TYPES:
        raise ImportRejected({"unknown document type": 1})
    df = typed_value_added(raw, munis)
    demand(value_added_checks(df, year, periods, doc_type, home))
    return sinks.align(df.withColumn("run_id", F.lit(run_id)), schemas.VALUE_ADDED)


def typed_index(raw: DataFrame, munis: DataFrame) -> DataFrame:
    df = require_columns(raw, INDEX_COLUMNS)
    t = df.select(
        codes.whole("ano").alias("year"), F.trim("etapa_indice").alias("stage"),
        F.trim("tipo_indice").alias("index_type"), F.col("indice_participacao").alias("raw_value"),
        codes.number("indice_participacao", 22, 16).alias("share"),
        codes.whole("codigo_municipio").alias("file_muni"),
    )
    return place(t, munis)


def index_checks(df: DataFrame, stage: str, index_type: str, home: str = K.HOME_STATE) -> DataFrame:
    """Rows failing each check; a municipality listed twice fails with all its rows."""
    per_muni = df.groupBy("file_muni").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.col("stage") != stage, F.lit(True))).alias("other_stage"),
        F.count_if(F.coalesce(F.col("index_type") != index_type, F.lit(True))).alias("other_type"),
        F.count_if(codes.blank_to_null("raw_value").isNull()).alias("no_value"),
        F.count_if(codes.blank_to_null("raw_value").isNotNull() & F.col("share").isNull()).alias("bad_value"),
        F.count_if(F.col("file_muni").isNull()).alias("no_muni"),
        F.count_if(F.coalesce(F.col("state") != home, F.lit(True))).alias("outside_state"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    twice = F.when((F.col("n") > 1) & F.col("file_muni").isNotNull(), F.col("n"))
    return per_muni.agg(
        F.when(total("n") == 0, 1).otherwise(0).cast("bigint").alias("empty_file"),
        *[total(c).alias(c) for c in ("other_stage", "other_type", "no_value", "bad_value", "no_muni", "outside_state")],
        total(twice).alias("repeated_muni"),
    )


def import_index(
    raw: DataFrame, munis: DataFrame, stage: str, index_type: str, run_id: int, home: str = K.HOME_STATE
) -> DataFrame:
    if stage not in K.INDEX_STAGES or index_type not in K.INDEX_TYPES:
        raise ImportRejected({"unknown stage or type": 1})
    df = typed_index(raw, munis)
    demand(index_checks(df, stage, index_type, home))
    return sinks.align(df.withColumn("run_id", F.lit(run_id)), schemas.SHARE_INDEX)
