"""Tables by month of which single months are replaced: a base whose folders in force a manifest names.

A replaced month is written whole below a new version; ``folders`` (month folder -> version) says which one counts.
A reader lists the folders in force only, and a filter on the month leaves only that month's.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.manifest import names_in
from ledgerloom.sources.tables import COMPACT_PARQUET, write_table

MONTH = "partition_month"

# Month folder -> version.
Folders = dict[str, int]


def month_of(time: str):
    return F.date_format(time, "yyyy-MM").alias(MONTH)


def read_months(spark: SparkSession, folder: str, folders: Folders, schema: str) -> DataFrame:
    """The rows in force with their month; ``schema`` (JSON) is that of an empty table."""
    fields = T.StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], fields)
    paths = [f"{folder}/version={version}/{month}" for month, version in sorted(folders.items())]
    return spark.read.option("basePath", folder).schema(fields).parquet(*paths).select(*fields.names)


def write_months(folder: str, version: int, rows: DataFrame) -> Folders:
    """Write ``rows`` by month below a new version and return the folders written."""
    path = f"{folder}/version={version}"
    write_table(rows, path, partition_by=MONTH, options=COMPACT_PARQUET)
    return dict.fromkeys((n for n in names_in(rows.sparkSession, path) if n.startswith(f"{MONTH}=")), version)


def replace_months(folder: str, folders: Folders, version: int, months: set[str], rows: DataFrame) -> Folders:
    """Write ``rows``, all there are of the ``months`` (folder names), and return the folders then in force.

    A month that has no rows any more is gone.
    """
    written = write_months(folder, version, rows)
    if not written.keys() <= months:
        raise ValueError(f"rows of months that are not replaced: {sorted(written.keys() - months)}")
    return {m: v for m, v in folders.items() if m not in months} | written


def month_folders(*rows: DataFrame) -> set[str]:
    """The folder names of the months that occur in ``rows``; as many as there are months."""
    found = {r[0] for df in rows for r in df.select(MONTH).distinct().collect()}
    return {f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if m is None else m}" for m in found}
