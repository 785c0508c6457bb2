"""Table sinks: Parquet (or CSV) folders, overwritten on every run."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Independent tables are written at the same time so small ones do not leave the cluster idle.
CONCURRENT_WRITES = 8

# Keep text as it is: by default the writer trims cells and escapes quotes with a backslash.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# For tables that are kept, or rewritten often: smaller files than those of the default codec.
COMPACT_PARQUET = {"compression": "zstd"}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Overwrite ``path`` with ``df`` and return the number of rows written; ``options`` are those of the format.

    The rows are counted by the writing tasks themselves, so there is no second pass. A
    partitioned table is rebalanced first: AQE splits an oversized partition value over several
    tasks and packs the small ones, so neither a hot day nor a swarm of tiny files results.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite")
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.options(**(options or {})).save(path)
    return written.get["rows"]


class Written(NamedTuple):
    """Rows of a written table, how long the write took, and the group of its jobs."""

    rows: int
    seconds: float
    group: str


def side_by_side(spark: SparkSession, jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """What independent jobs return that run at the same time, so that the short ones do not leave the cluster idle."""
    threads = {name: inheritable_thread_target(spark)(job) for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
        futures = {name: pool.submit(job) for name, job in threads.items()}
        return {name: future.result() for name, future in futures.items()}


def write_measured(
    tables: dict[str, DataFrame], folder: str, fmt: str = "parquet", partition_by: dict[str, str] | None = None
) -> dict[str, Written]:
    """Write independent tables side by side below ``folder``, the jobs of each in a group of its own.

    ``partition_by``: table -> the column that its files are partitioned by.
    """
    by = partition_by or {}

    def written(df: DataFrame, name: str) -> Written:
        group = f"{name}-{uuid.uuid4().hex}"
        df.sparkSession.sparkContext.setJobGroup(group, f"write {name}")
        begin = time.monotonic()
        rows = write_table(df, f"{folder}/{name}", fmt, by.get(name))
        return Written(rows, time.monotonic() - begin, group)

    jobs: dict[str, Callable[[], Written]] = {
        name: inheritable_thread_target(df.sparkSession)(lambda df=df, name=name: written(df, name))
        for name, df in tables.items()
    }
    with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: future.result() for name, future in futures.items()}


def write_tables(
    tables: dict[str, DataFrame], folder: str, fmt: str = "parquet", partition_by: dict[str, str] | None = None
) -> dict[str, int]:
    """:func:`write_measured`, with the row counts alone."""
    return {name: written.rows for name, written in write_measured(tables, folder, fmt, partition_by).items()}


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables written by :func:`write_tables` as Parquet."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
