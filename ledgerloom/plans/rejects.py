"""Rejected rows: raw rows with a number that its type cannot hold, set apart before staging.

Such a number must not be taken for a missing one, and one of them must not end a run over terabytes. A table is split
into the rows that staging can read and the rejected ones; the tasks that write staging count both, so the rejected rows
are looked for again only where there are some. A caller bounds their share.

A rejected row counts for nothing: if it was the last version of its key, the version before it stays.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.contract import unfit_cells
from ledgerloom.schema import INGEST_ORDINAL

# Share of a table's rows that may be rejected before a run stops.
MOST_REJECTED = 0.01

REJECTED = "table_name string, arrival string, column_name string, rule string, cell string"
RULE = "out_of_range"


class TooManyRejected(ValueError):
    """More rows of a table were rejected than the caller allows."""


def is_unfit(raw: DataFrame, table: str) -> Column:
    return reduce(Column.__or__, (unfit for _, unfit in unfit_cells(table, raw.columns)))


def fitting_rows(raw: DataFrame, table: str) -> DataFrame:
    return raw.where(~is_unfit(raw, table))


def rejected_cells(raw: DataFrame, table: str) -> DataFrame:
    """One row per cell that does not fit, with the row's place in the order of arrival."""
    cells = F.array(
        *(
            F.when(unfit, F.struct(F.lit(name).alias("column_name"), F.lit(RULE).alias("rule"), F.col(name).alias("cell")))
            for name, unfit in unfit_cells(table, raw.columns)
        )
    )
    arrival = F.lit(None).cast("string")
    if INGEST_ORDINAL in raw.columns:
        kind = raw.schema[INGEST_ORDINAL].dataType.typeName()
        arrival = F.to_json(INGEST_ORDINAL) if kind == "struct" else F.col(INGEST_ORDINAL).cast("string")
    return raw.where(is_unfit(raw, table)).select(
        F.lit(table).alias("table_name"), arrival.alias("arrival"), F.inline(F.array_compact(cells))
    )


class Split(NamedTuple):
    """The rows of a raw table that fit; both kinds are counted when they are read to the end."""

    rows: DataFrame
    tally: Observation


def counted_split(raw: DataFrame, table: str) -> Split:
    tally = Observation()
    # Told once per row, for the count and for the filter.
    marked = raw.withColumn("_unfit", is_unfit(raw, table))
    counted = marked.observe(tally, F.count(F.lit(1)).alias("rows"), F.count_if("_unfit").alias("rejected"))
    return Split(counted.where("NOT _unfit").drop("_unfit"), tally)


def rejected_rows(spark: SparkSession, raw: dict[str, DataFrame], splits: dict[str, Split]) -> DataFrame:
    """The rejected cells of the tables that have any by the tally of their splits."""
    found = [rejected_cells(raw[t], t) for t, split in splits.items() if split.tally.get["rejected"]]
    return reduce(DataFrame.union, found, spark.createDataFrame([], REJECTED))


def check_shares(splits: dict[str, Split], most: float) -> None:
    """Raise if more than ``most`` of a table's rows were rejected."""
    tallies = {table: split.tally.get for table, split in splits.items()}
    over = {t: f"{n['rejected']} of {n['rows']}" for t, n in tallies.items() if n["rejected"] > most * n["rows"]}
    if over:
        raise TooManyRejected(f"rejected rows above a share of {most}: {over}")
