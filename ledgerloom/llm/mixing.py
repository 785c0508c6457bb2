"""Mix sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Each source has a budget in words. Its documents get a hash-random key and are range-sorted by (source, key), so a
hot source spans many partitions; each partition adds up its own rows, the few partition sums are added up along the
order, and every document learns how many words of its source stand before it. A source whose budget is larger than
its size is repeated in whole epochs; the last epoch is cut at the exact word.

The order depends only on the rows and the seed, so reruns agree.

Defined results: a null text has no words; a null source is a source of its own, the last in order; a document
without words takes none; rows that are equal in all named columns share one place in the order and count one after
the other; an empty table gives an empty table. Columns other than those named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources import work_folder

# What stands between words.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int) -> DataFrame:
    """Add ``weight``: 1, 2, ..., ``cycle``, repeating, for sources by code point, null last.

    ``sources`` has one row per source, an aggregate; its ordinal is taken over that table.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))


def target_sizes(sources: DataFrame, most: int) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): all sizes shared by weight, none above ``most`` sizes.

    Sources that reach their limit first are those with the least size per weight. In that order a source stays
    free if the words that the limits before it leave, shared among the weights from it on, are within its limit.
    The words per weight of the free sources are the same for all, so the first free source fixes them.
    """
    limit = F.col("source_size") * most
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shared = (
        sources.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_free", F.col("_left").cast("double") * F.col("weight") / F.col("_weights") <= limit)
    )
    place = F.struct((F.col("source_size") / F.col("weight")).alias("a"), "weight", F.col("source").isNull().alias("b"), "source")
    level = F.min_by(F.struct("_left", "_weights"), F.when(F.col("_free"), place)).over(everything)
    # Sums of whole numbers are exact, so the same division gives the same double everywhere.
    share = level["_left"].cast("double") * F.col("weight") / level["_weights"]
    return (
        shared.withColumn("target", F.least(F.coalesce(share, F.lit(0.0)), limit.cast("double")))
        .select("source", "source_size", "weight", "target")
    )


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    cycle: int = 3,
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes from the document: ``size`` for each whole epoch and what the
    budget leaves in the last one.
    """
    spark = docs.sparkSession
    sized = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    # The order key is hexadecimal text, so both engines of the checks can compute it.
    drawn = sized.withColumn("draw", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))))
    ranged = drawn.repartitionByRange(
        F.col("source").asc_nulls_last(), "draw", F.col("key").asc_nulls_first(), "size"
    ).withColumn("chunk", F.spark_partition_id())
    # Written once: a second sampling of the range bounds could deal the rows otherwise.
    folder = work_folder(spark, "mixing")
    ranged.write.parquet(folder)
    rows = spark.read.parquet(folder)

    chunks = rows.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    sources = chunks.groupBy("source").agg(F.sum("chunk_size").alias("source_size"))
    targets = target_sizes(cyclic_weights(sources, cycle), most)
    along = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        chunks.withColumn("begin", F.coalesce(F.sum("chunk_size").over(along), F.lit(0)))
        .withColumnsRenamed({"source": "_source", "chunk": "_chunk"})
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .select("_source", "_chunk", "begin", "source_size", "target")
    )
    within = (
        Window.partitionBy("chunk", "source")
        .orderBy("draw", F.col("key").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        begins, (F.col("chunk") == F.col("_chunk")) & F.col("source").eqNullSafe(F.col("_source"))
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("begin") - F.col("_before")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"),
    )
