"""Operations between two taxpayers, and invoices matched with ledger entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions import rules
from apportia.operators import spans

PAIR = ["entry_reg", "entry_state", "exit_reg", "exit_state"]


def _party(side: str) -> Column:
    return F.struct(F.col(f"{side}_reg").alias("reg"), F.col(f"{side}_state").alias("state"))


def pair_counts(docs: DataFrame) -> DataFrame:
    """Documents per unordered pair and direction; the lesser party is ``a``."""
    s, e = _party("exit"), _party("entry")
    return (
        docs.select(F.least(s, e).alias("a"), F.greatest(s, e).alias("b"), (s <= e).alias("forward"))
        .groupBy("a", "b")
        .agg(
            F.count_if("forward").alias("a_to_b"),
            F.count_if(~F.col("forward")).alias("b_to_a"),
        )
    )


def bidirectional_pairs(docs: DataFrame) -> DataFrame:
    """Pairs that sell to each other in both directions."""
    both = pair_counts(docs).where((F.col("a_to_b") > 0) & (F.col("b_to_a") > 0))
    return both.select(
        F.col("a.reg").alias("a_reg"), F.col("a.state").alias("a_state"),
        F.col("b.reg").alias("b_reg"), F.col("b.state").alias("b_state"), "a_to_b", "b_to_a",
    )


def between_listed_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Documents of listed pairs in either direction.

    Ordering the two parties turns the either-way match into one equality.
    """
    s, e = _party("exit"), _party("entry")
    a = F.struct(F.col("a_reg").alias("reg"), F.col("a_state").alias("state"))
    b = F.struct(F.col("b_reg").alias("reg"), F.col("b_state").alias("state"))
    listed = pairs.select(F.least(a, b).alias("__lo"), F.greatest(a, b).alias("__hi")).distinct()
    keyed = docs.withColumns({"__lo": F.least(s, e), "__hi": F.greatest(s, e)})
    return keyed.join(listed, ["__lo", "__hi"], "left_semi").drop("__lo", "__hi")


def operation_totals(items: DataFrame) -> DataFrame:
    """Value per ordered pair, operation code and product group."""
    return items.groupBy(*PAIR, "op_code", "product").agg(
        F.sum("value_added").alias("value_added"), F.sum("gross").alias("gross")
    )


def opposite_operations(totals: DataFrame) -> DataFrame:
    """Side of each opposite pair to exclude: the smaller gross total, neither on an exact tie.

    A match is the reversed pair with the mirrored code and the same product group. The join runs
    on totals, so its size follows the number of combinations, not of items.
    """
    mirrored = totals.withColumn("mirror", rules.mirrored_op_code("op_code"))
    other = mirrored.where(F.col("mirror").isNotNull()).select(
        F.col("exit_reg").alias("entry_reg"), F.col("exit_state").alias("entry_state"),
        F.col("entry_reg").alias("exit_reg"), F.col("entry_state").alias("exit_state"),
        F.col("mirror").alias("op_code"), "product", F.col("gross").alias("other_gross"),
    )
    keys = [*PAIR, "op_code", "product"]
    return totals.join(other, keys).where(F.col("gross") < F.col("other_gross")).select(*keys)


def exclude_opposite(
    items: DataFrame, excluded: DataFrame, doc_keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(items with the duplicate flag, documents whose value changes).

    A changed document keeps the gross of its other items; zero gives reason 12.
    """
    keys = [*PAIR, "op_code", "product"]
    mark = excluded.select(*keys).distinct().withColumn("__dup", F.lit(True))
    flagged = items.join(mark, keys, "left").withColumn("duplicate", F.coalesce("__dup", F.lit(False)))
    flagged = flagged.drop("__dup")
    docs = (
        flagged.groupBy(*doc_keys)
        .agg(
            F.sum("gross").alias("before"),
            F.sum(F.when(~F.col("duplicate"), F.col("gross")).otherwise(0)).alias("value_added"),
        )
        .where(F.col("before") != F.col("value_added"))
        .select(
            *doc_keys, "value_added",
            F.when(F.col("value_added") == 0, K.NO_ITEM_LEFT).cast("int").alias("reason"),
        )
    )
    return flagged, docs


def match_by_key(ledger: DataFrame, issued: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Invoice documents found in the ledger by access key; columns are united by name."""
    left = ledger.select(key, F.col("doc_id").alias("ledger_id"), F.col("doc_type").alias("ledger_type"))
    invoices = issued.select(key, "doc_id", "doc_type").unionByName(received.select(key, "doc_id", "doc_type"))
    right = invoices.select(key, F.col("doc_id").alias("invoice_id"), F.col("doc_type").alias("invoice_type"))
    # Each side is made distinct before the join, so the pairs are, and no task holds a table of them.
    return left.distinct().join(right.distinct(), key)


MATCH = ["invoice_id", "invoice_type", "ledger_id", "ledger_type"]


def positional_match(
    invoice_items: DataFrame, ledger_items: DataFrame, keys: list[str], order: list[str], span: Column
) -> DataFrame:
    """k-th invoice item beside the k-th ledger item of the same document pair, outer.

    Positions come from spans of the item order, so a document with a huge item list is numbered
    by many tasks. Columns other than keys get the suffixes _invoice and _ledger.
    """
    rest = lambda df: [c for c in df.columns if c not in keys]
    name = lambda df, s: [F.col(c).alias(f"{c}_{s}") for c in rest(df)]
    left = spans.position(invoice_items, keys, order, span)
    right = spans.position(ledger_items, keys, order, span)
    left = left.select(*keys, "position", *name(invoice_items, "invoice"))
    right = right.select(*keys, "position", *name(ledger_items, "ledger"))
    return left.join(right, [*keys, "position"], "full_outer")


def fixed_assets(matched: DataFrame, invoice_key: list[str], item: str) -> tuple[DataFrame, DataFrame]:
    """(items with reason 3, documents with reason 12 and no value) for matched positions."""
    hit = matched.where(
        F.col(f"{item}_invoice").isNotNull() & F.col(f"{item}_ledger").isNotNull()
    )
    items = hit.select(*invoice_key, F.col(f"{item}_invoice").alias(item)).distinct().withColumn(
        "reason", F.lit(K.FIXED_ASSET)
    )
    docs = (
        hit.select(*invoice_key).distinct()
        .withColumn("value_added", F.lit(0).cast("decimal(17,2)"))
        .withColumn("reason", F.lit(K.NO_ITEM_LEFT))
    )
    return items, docs
