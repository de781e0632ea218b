"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportia.llm.common import stored

WEIGHTS = (5, 2, 1)
BLOCK_WORDS, DOCS_UNIT, SEED = 16, 64, 17
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str) -> Column:
    return F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.regexp_count(F.col(text), F.lit(WORD))).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Sources by code point, null last, weigh ``weights``, repeating, and share ``share`` times all words.
    No target is above ``most`` times its source; the excess is shared again by weight. With sources in
    the order in which they fill up, that is one running sum: all before the first that holds are full.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").asc_nulls_last())
    fill = everything.orderBy(F.col("full") / F.col("weight"), "at")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("at") - 1) % len(weights) + 1).cast("int"))
    level = (
        (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    return (
        sizes.withColumn("at", F.row_number().over(order)).withColumn("weight", w)
        .withColumn("full", F.lit(float(most)) * F.col("source_size"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("full") / F.col("weight"), F.col("level"))).over(everything))
        .withColumn("target", F.least("full", F.coalesce(F.col("level") * F.col("weight"), F.col("full"))).cast("double"))
        .drop("at", "weight", "full", "level")
    )


def apportion(df: DataFrame, group: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë: add ``quota``, the seats that each row gets of its group's ``seats``.

    Seats go to the highest quotients votes / (2 k - 1), ties to the smaller key. Two divisors bound each
    quota from below and above, so only the few quotients between them are listed and ranked.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    some = F.col(votes) > 0
    rate = lambda half: (
        F.col(votes) * F.greatest(F.col(seats) + half * F.col("_n") / 2, F.lit(0.0)) / F.col("_all") + F.lit(0.5)
    )
    bounds = (
        df.withColumn("_n", F.count(F.when(some, 1)).over(g)).withColumn("_all", F.sum(votes).over(g))
        .withColumn("_low", F.when(some, F.greatest(F.floor(rate(-1)) - 1, F.lit(0))).otherwise(0).cast("long"))
        .withColumn("_high", F.when(some, F.floor(rate(1)) + 1).otherwise(0).cast("long"))
        .withColumn("_open", (F.col(seats) - F.sum("_low").over(g)).cast("long"))
    )
    listed = bounds.where("_high > _low").withColumn("_k", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))))
    rank = F.row_number().over(g.orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), key))
    won = (
        listed.withColumn("_rank", rank).where("_rank <= _open")
        .groupBy(*group, key).agg(F.count("*").alias("_won"))
    )
    return (
        bounds.join(won, [*group, key], "left")
        .withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0)))
        .drop("_n", "_all", "_low", "_high", "_open", "_won")
    )


def mix(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """How many words the mix takes of each document: doc_id, size, source_size, target, taken.

    Each source's words stand in a seeded order, cut into shards by the same hash. Sainte-Laguë gives
    sources blocks of ``block`` words by target and then gives each shard its integer quota by words. A
    shard takes the first blocks of its seeded order, going round a second time beyond its own words.

    A null source is a source of its own; null and empty texts have size 0 and nothing is taken of them;
    repeated rows each count; an empty table gives no rows; columns besides doc_id, text and source are
    not read. Documents are dealt by source and shard, not by source; windows over them stay within shards, whose size grows with the root of the source.
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    sized = docs.select("doc_id", "source", words_of("text").alias("size"))
    keyed = stored(sized.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))))
    sources = keyed.groupBy("key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    given = apportion(
        targets(sources, share, most)
        .withColumn("seats", F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block).cast("long")),
        [], "key", "target", "seats",
    ).select(
        "key", "source_size", "target", F.col("quota").alias("source_quota"),
        F.ceil(F.sqrt(F.col("n_docs") / DOCS_UNIT)).cast("long").alias("n_shards"),
    )
    dealt = (
        keyed.withColumn("order", order).join(given, "key")
        .withColumn("shard", F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("n_shards"))
        .repartition("key", "shard")
    )
    shards = dealt.groupBy("key", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(shards, ["key"], "shard", "shard_size", "source_quota").select(
        "key", "shard", "shard_size", (F.col("quota") * block).alias("quota")
    )
    stream = Window.partitionBy("key", "shard").orderBy("order", "doc_id", "size")
    before = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    part = lambda words: F.least(F.col("size"), F.greatest(words, F.lit(0)))
    return (
        dealt.withColumn("before", before).join(quotas, ["key", "shard"])
        .select(
            "doc_id", "size", "source_size", "target",
            (part(F.col("quota") - F.col("before")) + part(F.col("quota") - F.col("shard_size") - F.col("before")))
            .cast("long").alias("taken"),
        )
    )
