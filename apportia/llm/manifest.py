"""Merkle dataset manifest: ranks are cut into base-3 digits and grouped away, each child a struct in its parent's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportia.llm.common import stored

#: Nodes that one node of the next level covers, and levels that one nested block holds (3^7 = 2187 leaves).
FAN, LEVELS = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"


def field(value: str | Column) -> Column:
    """UTF-8 length, a colon and the value; ``-`` for null."""
    text = (F.col(f"`{value}`") if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Add ``rank``, from 0 within the key by ``order``, and ``n``, the rows of the key.

    Rows are dealt by ranges of key and order and stored with their place in the range; a running sum over
    ranges, of which there are as many as partitions, gives the rest. Rows alike in all of these are told
    apart by their place in the input, so that a large group of them does not share a range.
    """
    apart = rows.withColumn("_apart", F.monotonically_increasing_id())
    along = [F.col(c).asc_nulls_first() for c in [*key, *order, "_apart"]]
    placed = stored(
        apart.repartitionByRange(*along).sortWithinPartitions(*along).drop("_apart")
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33))
        .withColumn("_key", F.struct(*key))
    )
    parts = placed.groupBy("_key", "_range").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    all_ranges = Window.partitionBy("_key")
    before = all_ranges.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_key", "_range", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(all_ranges).alias("n"),
    )
    return (
        placed.join(offsets, ["_key", "_range"])
        .withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before"))
        .select(*rows.columns, "rank", "n")
    )


def nested(nodes: DataFrame, levels: int) -> DataFrame:
    """One row (key, block, n, digest, children) for each ``FAN ** levels`` consecutive nodes of a key.

    nodes: key, rank, n, digest, row. Digit columns of the rank are grouped away from the last on; rows are
    dealt by key and block once, which serves all groupings. A level at which a key has one node is passed
    through: that node is what remains. Blocks are bounded, so no group grows with the input.
    """
    digits = [f"_d{i}" for i in range(levels)]
    level = nodes.select(
        F.struct("key").alias("_key"), F.floor(F.col("rank") / FAN**levels).alias("block"), "n",
        *[F.pmod(F.floor(F.col("rank") / FAN**i), F.lit(FAN)).alias(d) for i, d in enumerate(digits)],
        "digest", F.col("row").alias("held"),
    ).repartition("_key", "block")
    for i, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("d"), "digest", "held")
        level = level.groupBy("_key", "block", *digits[i + 1 :]).agg(
            F.max("n").alias("n"), F.sort_array(F.collect_list(child)).alias("held")
        ).withColumn(
            "digest",
            F.when(F.col("n") > FAN**i, digest_of(F.concat_ws("", F.col("held.digest")))).otherwise(F.col("held")[0]["digest"]),
        )
    return level.select(F.col("_key.key").alias("key"), "block", "n", "digest", "held")


def emitted(tops: DataFrame, levels: int) -> DataFrame:
    """The nodes below blocks: key, rank, row, subroot and ``path``, their steps up to the root.

    tops: key, block, n, held, path, subroot. A step has the digests left and right of a node in its run, both
    empty for a run of one; where a key has one node there is no step.
    """

    def beside(run: Column, child: Column, left: bool) -> Column:
        return F.concat_ws("", F.transform(
            F.filter(run, lambda c: (c["d"] < child["d"]) if left else (c["d"] > child["d"])), lambda c: c["digest"]
        ))

    def opened(nodes: Column, level: int) -> Column:
        def children(node: Column) -> Column:
            run = node["held"]

            def one(child: Column) -> Column:
                step = F.struct(beside(run, child, True).alias("left"), beside(run, child, False).alias("right"))
                taken = F.when(F.col("n") > FAN**level, F.array(step)).otherwise(F.array().cast(f"array<{STEP}>"))
                rank = node["rank"] * FAN + child["d"]
                return F.struct(rank.alias("rank"), child["held"].alias("held"), F.concat(taken, node["path"]).alias("path"))

            return F.transform(run, one)

        return F.flatten(F.transform(nodes, children))

    found = F.array(F.struct(F.col("block").alias("rank"), "held", "path"))
    for level in reversed(range(levels)):
        found = opened(found, level)
    return tops.select("key", "subroot", F.explode(found).alias("_node")).select(
        "key", "subroot", "_node.rank", F.col("_node.held").alias("row"), "_node.path"
    )


def united(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the path of the node that each is on the level above: both have one row per key and block."""
    here = blocks.select(F.struct("key", "block").alias("at"), F.struct("n", "held").alias("down"))
    there = above.select(F.struct("key", F.col("rank").alias("block")).alias("at"), F.struct("path", "subroot").alias("up"))
    both = here.unionByName(there, allowMissingColumns=True).groupBy("at").agg(
        F.first("down", ignorenulls=True).alias("down"), F.first("up", ignorenulls=True).alias("up")
    )
    return both.select("at.*", "down.*", "up.*")


def rolled(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored blocks from the bottom up, and the one node that each key ends in (key, digest)."""
    tiers, most = [], 2
    while most > 1:
        blocks = stored(nested(nodes, levels))
        tiers.append(blocks)
        nodes = blocks.select(
            "key", F.col("block").alias("rank"), F.ceil(F.col("n") / FAN**levels).alias("n"), "digest", F.lit(0).alias("row")
        )
        most = nodes.agg(F.max("n")).first()[0] or 0
    return tiers, nodes.select("key", "digest")


def unrolled(tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Every bottom node with its path. tops: key, path and subroot of the node that each key ends in."""
    nodes = tops.withColumn("rank", F.lit(0).cast("long"))
    for blocks in reversed(tiers):
        nodes = emitted(united(blocks, nodes), levels)
    return nodes


def folded(digest: str | Column, path: str | Column) -> Column:
    """The root that a digest and its steps give."""
    return F.aggregate(path, digest, lambda a, s: digest_of(s["left"], a, s["right"]))


def proof(path: str | Column) -> Column:
    """Digests beside a node and its parents, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def leaves(docs: DataFrame, now: str | Column = "text") -> DataFrame:
    """doc_id, source, leaf, and ``now``: the leaf with another text, such as one found later."""
    head = [field(c) for c in FIELDS[:-1]]
    return docs.select("doc_id", "source", digest_of(*head, field("text")).alias("leaf"), digest_of(*head, field(now)).alias("now"))


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, leaf, now, subroot, root and ``path`` of each row of ``leaves``.

    Per source, leaves ascend by doc_id (nulls first, ties by leaf) and runs of three become their digest
    until one node is left, the subroot; subroots by source (null first, bytewise) give the root likewise.

    Blocks meet their paths by a grouping that has two rows a block; leaves are in no join but that for their
    ranks. A null source is a source; null fields are marked in the leaf; repeated rows are leaves of their
    own; texts are hashed whole, however long; an empty table gives no rows; columns besides those of
    ``FIELDS`` are not read.
    """
    bottom = ranked(stored(rows), ["source"], ["doc_id", "leaf", "now"]).select(
        F.col("source").alias("key"), "rank", "n", F.col("leaf").alias("digest"), F.struct("doc_id", "leaf", "now").alias("row")
    )
    by_source, subroots = rolled(bottom, levels)
    sources = ranked(subroots.select(F.lit(0).alias("all"), "key", "digest"), ["all"], ["key"]).select(
        F.col("all").alias("key"), "rank", "n", "digest", F.struct(F.col("key").alias("source"), F.col("digest").alias("subroot")).alias("row")
    )
    over_all, root = rolled(sources, levels)
    top = root.first()
    start = root.select("key", F.array().cast(f"array<{STEP}>").alias("path"), F.lit(None).cast("string").alias("subroot"))
    tops = unrolled(over_all, start, levels).select(F.col("row.source").alias("key"), "path", "row.subroot")
    return unrolled(by_source, tops, levels).select(
        "row.doc_id", F.col("key").alias("source"), "row.leaf", "row.now", "subroot",
        F.lit(top and top["digest"]).cast("string").alias("root"), "path",
    )
