"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """``(key, _rows)`` for every key that is not null; rows are counted per task before the shuffle."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def frequent_of(counts: DataFrame, key: str) -> DataFrame:
    """:func:`frequent_keys` from counts that are needed anyway."""
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("_rows")).scalar()
    shares = F.col("_rows") * F.lit(partitions) / total
    return counts.where(shares > 1).select(key, F.ceil(shares).cast("int").alias("_fan"))


def frequent_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, _fan)`` for keys that hold more than one shuffle partition's share of the rows.

    The counts are exact, so every evaluation gives the same list; fewer keys than there are shuffle partitions can
    exceed one share. ``_fan`` is the number of shares the key has. The list only steers where rows go, never which
    rows are joined.
    """
    return frequent_of(key_counts(df, key), key)


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    frequent: DataFrame,
    spread_by: Sequence[str],
    how: str = "left",
    also_on: Sequence[str] = (),
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``key`` (and ``also_on``), splitting the facts of frequent keys.

    A frequent key's facts go to ``_fan`` buckets and its lookup rows are repeated once per
    bucket; all other keys use bucket 0. The bucket is a hash of ``spread_by`` and the input
    partition, so copies of one row split too and a re-run task sends its rows the same way.
    ``frequent`` has fewer rows than there are shuffle partitions and is broadcast. A lookup
    below the session's broadcast threshold is still broadcast by Spark itself.
    """
    hot = F.broadcast(frequent)
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A null key matches nothing, so its facts may go anywhere.
    fan = F.when(F.col(key).isNull(), F.lit(partitions)).otherwise(F.coalesce("_fan", F.lit(1)))
    bucket = F.when(fan > 1, F.pmod(F.xxhash64(F.spark_partition_id(), *spread_by), fan)).otherwise(0)
    spread = facts.join(hot, key, "left").withColumn("_bucket", bucket.cast("int")).drop("_fan")
    last_bucket = F.coalesce(F.col("_fan"), F.lit(1)) - 1
    repeated = (
        lookup.join(hot, key, "left")
        .withColumn("_bucket", F.explode(F.sequence(F.lit(0), last_bucket)))
        .drop("_fan")
    )
    return spread.join(repeated, [key, *also_on, "_bucket"], how).drop("_bucket")
