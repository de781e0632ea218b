"""One query per operator, with comparison SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportia.llm import decontamination, jaccard, langid, lines, manifest, mixing, periods, pii, quality, substrings, topk, toxicity, wrappers
from apportia.llm.common import remainder_of_id, table
from apportia.llm.sql import MANIFEST_SQL, MIX_SQL, TOP_SQL


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extracted(table(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans, and those that the trees add."""
    docs = table(spark, sf_dir, "documents")
    found = pii.found_in(docs, pii.fit(docs))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.size(pii.of_kind("base", k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat(F.col("base"), *[pii.of_kind("added", k) for k in pii.GENERATORS])).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document, learnt from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    weights = toxicity.model(docs, labels.where(remainder_of_id("doc_id", 3) != 1))
    return docs.select("doc_id", toxicity.score_of("text", weights).alias("score")).select(
        "doc_id", (remainder_of_id("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that each document keeps when strings of 400 bytes that start anywhere else are removed."""
    return substrings.without_repeats(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors, by integer inner product, of each vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.whole_numbers("embedding", 1024).alias("vector")
    )
    return topk.top_k(vectors.where("id % 100 = 0"), vectors)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learnt from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    machines = langid.model(docs.where(remainder_of_id("doc_id", 4) != 2))
    return langid.predicted(docs, machines).select(
        "doc_id", (remainder_of_id("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that each document keeps after aligned blocks of earlier documents are deleted from it."""
    total = lambda f: F.aggregate("gone", F.lit(0), lambda s, b: s + f(b))
    return lines.deduplicated(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), total(lambda b: b["lines"]).cast("long").alias("n_removed"),
        F.size("gone").cast("long").alias("n_blocks"), F.length("kept").cast("long").alias("n_kept_chars"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents repeat."""
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, copies and links of every document."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusion proof of every document, and whether it still holds where line ends were deleted since."""
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(remainder_of_id("doc_id", 2) == 0, F.lit(False))
    now = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest.manifest(manifest.leaves(docs, now)).withColumn("folded_root", manifest.folded("now", "path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof("path").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, learnt from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    learnt = quality.model(docs, labels.where(remainder_of_id("doc_id", 4) != 2))
    return docs.select("doc_id", quality.score_of("text", learnt).alias("score")).select(
        "doc_id", (remainder_of_id("doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in each document; every tenth one is made to repeat from some word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    sized = docs.withColumn("g", F.floor(h / 10)).withColumn("n", F.when(h % 10 == 0, mixing.words_of("text")))
    begun = sized.withColumn("start", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = 1 + F.floor((F.col("n") - F.col("start")) / (3 + F.col("g") % 8))
    best = F.col("best")
    return periods.periodic(begun.withColumn("period", period)).withColumn("best", periods.longest("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))).cast("binary"), 256)
        .alias("runs_sha256"),
        "collapsed_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_pii, op3_toxicity, op4_substring_dedup, op5_top_k, op6_language, op7_source_mix, op8_line_dedup, op9_decontamination,
        op10_jaccard_join, op11_manifest, op12_quality, op13_periodic_runs,
    )
}
ORACLE: dict[str, str] = {"op5_top_k": TOP_SQL, "op7_source_mix": MIX_SQL, "op11_manifest": MANIFEST_SQL}
