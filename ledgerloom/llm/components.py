"""Connected components of a link table, by alternating large-star and small-star steps.

Each step replaces links so that they point at smaller nodes; components are never changed, and after few rounds
(logarithmic in the longest chain) every node is linked to the smallest node of its component. A step is an
aggregate and a join by node; links of one node are never gathered. Every round is written to the shared folder, so
a lost executor costs one round and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources import work_folder


def _state(links: DataFrame) -> tuple[int, int]:
    """Number of links and a hash of the whole set; equal for equal sets."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        # Exclusive or does not overflow and does not depend on the order.
        F.bit_xor(F.xxhash64("u", "v")).alias("h"),
    ).first()
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (u, v: bigint) that is not the smallest of its component."""
    spark = links.sparkSession

    def written(step: DataFrame) -> DataFrame:
        folder = work_folder(spark, "components")
        step.write.parquet(folder)
        return spark.read.parquet(folder)

    def towards_smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))

    # Greater node first.
    now = written(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(towards_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = written(large)
        smallest = towards_smallest(large)
        small = (
            large.join(smallest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        now, before = written(small), state
        state = _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
