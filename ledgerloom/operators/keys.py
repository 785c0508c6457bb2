"""Key checks. Each one counts per key before any shuffle or join, so a hot key is one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose ``columns`` are all present.

    A plain null test: ``na.drop`` adds a second copy of every key expression to the scan filter.
    """
    return df.where(reduce(Column.__and__, (F.col(name).isNotNull() for name in columns)))


def require_text(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text ``column`` is not blank."""
    return df.where(F.col(column) != "")


def parsed_once(df: DataFrame, condition: Column) -> DataFrame:
    """Rows of ``df`` that meet a ``condition`` on columns that are dear to compute.

    Spark moves a filter below the projection that computes its columns, and then computes each of them a second
    time, with all it is made of written out again. It leaves a filter where it is whose projection holds a value
    that depends on the task.
    """
    placed = df.withColumn("_task", F.spark_partition_id())
    return placed.where(condition & (F.col("_task") >= 0)).drop("_task")


def require_parsed_keys(df: DataFrame, *columns: str) -> DataFrame:
    """:func:`require_keys` on columns parsed from text."""
    return parsed_once(df, reduce(Column.__and__, (F.col(name).isNotNull() for name in columns)))


def require_parsed_text(df: DataFrame, column: str) -> DataFrame:
    """:func:`require_text` on a column parsed from text."""
    return parsed_once(df, F.col(column) != "")


def duplicate_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: how many rows share their non-null key with another row, all copies counted."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    repeated = F.sum(F.when(F.col("copies") > 1, F.col("copies")))
    return per_key.agg(F.coalesce(repeated, F.lit(0)).alias(name))


def fk_violations(df: DataFrame, key: str, parents: DataFrame, name: str) -> DataFrame:
    """One row: how many rows carry a ``key`` that ``parents`` lacks; a null key counts."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    orphans = per_key.join(parents.select(key).distinct(), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias(name))
