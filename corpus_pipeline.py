"""Documents to a training mix: each stage reads what the one before it has kept.

Every stage but the last returns the columns of documents; line dedup changes texts (and n_chars), the others
rows only. Null and empty texts, rows without an id, repeated rows and columns of other names pass every stage
but near-copy removal, which leaves one of equal rows. Texts are worked whole. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia.llm import decontamination, jaccard, lines, mixing, toxicity
from apportia.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7, learnt from the labelled ones; null and empty texts stay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return docs.where(toxicity.score_of("text", toxicity.model(docs, labels)) < TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the blocks of lines that earlier ones hold; one of which nothing is left goes.

    n_chars, where there is such a column, is counted again for texts that changed.
    """
    found = lines.deduplicated(docs)
    changed = F.size("gone") > 0
    column = {"text": F.col("kept"), "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.where(~changed | (F.trim(F.col("kept")) != "")).select(*[
        column.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns
    ])


def keyed(docs: DataFrame) -> tuple[str, DataFrame]:
    """A digest of id and text under a name that docs has not: one of each row that is not repeated, null ids included."""
    name = "row_key"
    while name in docs.columns:
        name += "_"
    return name, docs.withColumn(name, F.xxhash64("doc_id", "text"))


def columns_of(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: of least id, a null id last, and then of least text digest.

    Documents of one id and different texts are different documents. Of rows that repeat id and text one stays,
    the least by its other columns as JSON.
    """
    key, rows = keyed(docs)
    ids = stored(rows.groupBy(key).agg(F.first("doc_id").alias("id"), F.count("*").alias("n")))
    classes = jaccard.classes(rows.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias(key), "class_id").distinct()
    placed = stored(classes.join(ids, key))
    first = placed.groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull(), "id", key))[key].alias(key))
    gone = stored(placed.select(key).join(first, key, "left_anti"))
    kept = rows.join(gone, key, "left_anti")
    twice = stored(ids.where("n > 1").select(key))
    row = F.struct(*columns_of(docs))
    one = kept.join(twice, key, "left_semi").groupBy(key).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return kept.join(twice, key, "left_anti").select(*columns_of(docs)).unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item, whether they have an id or not."""
    key, rows = keyed(docs)
    found = decontamination.overlaps(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = stored(found.select(F.col("doc_id").alias(key)).distinct())
    return rows.join(hit, key, "left_anti").select(*columns_of(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document that is left."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated), ("mix", mix),
]
#: The first stage learns its weights, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
