"""Running totals and neighbours along an order, without gathering a key's rows in one task.

A plain window puts all rows of a key into one task. Here the rows are range-partitioned on the
key *and* the order, so a hot key spans many chunks; windows run inside a chunk and what they
need from other chunks is one summary row per key and chunk. The chunks are written once: a
second sampling of the range bounds could cut the rows differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered_chunks(df: DataFrame, key: str, order: Sequence[str], folder: str) -> DataFrame:
    """``df`` with ``_chunk``, which ascends along ``(key, *order)``; written to ``folder`` and read back.

    The number of chunks is not fixed, so adaptive execution sizes them; neighbours that it joins stay in order.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(key, *order).withColumn("_chunk", F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def running_total(df: DataFrame, key: str, order: Sequence[str], value: str, total: str, folder: str) -> DataFrame:
    """Add ``total``: the sum of ``value`` over the key's rows up to and including this one."""
    chunks = ordered_chunks(df, key, order, folder)
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = (
        chunks.groupBy(key, "_chunk")
        .agg(F.sum(value).alias("_sum"))
        .select(key, "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunks.join(per_chunk, [key, "_chunk"])
        .withColumn(total, F.col("_before") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_before", "_chunk")
    )


def value_spans(df: DataFrame, key: str, order: str, value: str, folder: str) -> DataFrame:
    """One row per run of equal ``value`` of a key: ``valid_from``, ``valid_to`` and ``is_current``.

    ``order`` is unique within a key. A null value is a value like any other.
    """
    chunks = ordered_chunks(df.select(key, order, value), key, [order], folder)
    by_chunk = Window.partitionBy(key).orderBy("_chunk")
    within = Window.partitionBy(key, "_chunk").orderBy(order)

    # The value a chunk inherits from the chunk before it, wrapped so that a null is not "none".
    inherited = (
        chunks.groupBy(key, "_chunk")
        .agg(F.max_by(F.struct(value), order).alias("_last"))
        .select(key, "_chunk", F.lag("_last").over(by_chunk).alias("_inherited"))
    )
    previous = F.coalesce(F.lag(F.struct(value)).over(within), F.col("_inherited"))
    changes = (
        chunks.join(inherited, [key, "_chunk"])
        .withColumn("_previous", previous)
        .where(F.col("_previous").isNull() | ~F.col(value).eqNullSafe(F.col("_previous")[value]))
        .select(key, "_chunk", value, F.col(order).alias("valid_from"))
    )

    # A span ends where the next one starts, in this chunk or in the key's next chunk with a change.
    next_chunk = (
        changes.groupBy(key, "_chunk")
        .agg(F.min("valid_from").alias("_first"))
        .select(key, "_chunk", F.lead("_first").over(by_chunk).alias("_next"))
    )
    in_chunk = Window.partitionBy(key, "_chunk").orderBy("valid_from")
    valid_to = F.coalesce(F.lead("valid_from").over(in_chunk), F.col("_next"))
    return (
        changes.join(next_chunk, [key, "_chunk"])
        .select(key, value, "valid_from", valid_to.alias("valid_to"))
        .withColumn("is_current", F.col("valid_to").isNull())
    )
