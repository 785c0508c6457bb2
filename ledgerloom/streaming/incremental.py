"""Incremental ingest with Structured Streaming: only new raw files are read.

Each micro-batch is typed, reduced to the last row per key where the table has one, and stored under its
batch id, so a batch that runs again after a failure replaces itself. The current table is the same reduction over
the last compacted base and the batches since. Streaming deduplication would keep the *first* row of a key, hence
the stored batches. Rows with a number that does not fit are set apart below ``rejected/batch_id=N``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.rejects import counted_split, rejected_cells
from ledgerloom.sources import read_raw_csv
from ledgerloom.sources.raw import first_line
from ledgerloom.sources.tables import COMPACT_PARQUET
from ledgerloom.streaming.stored import (
    VERSIONED,
    is_reduced,
    last_batch,
    reduced,
    reduced_again,
    stored_changes,
    stored_rows,
    whole_parts,
)

# Files of one micro-batch; their paths and header lines come to the driver.
FILES_PER_BATCH = 1000
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def read_files_by_name(spark: SparkSession, headers: dict[str, list[str]], table: str) -> DataFrame:
    """Raw ``table`` from files given per header line, so columns may come in any order and optional ones are kept."""
    scans = [read_raw_csv(spark, paths, table) for paths in headers.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def ingest_new_files(
    spark: SparkSession, raw_folder: str, table: str, state_folder: str, datetime_formats: Sequence[str] = ()
) -> None:
    """Read the files of ``raw_folder`` that no earlier call has read and store their changes.

    Progress lives next to the stored batches, so a restarted call goes on where the last one
    stopped. The stream only finds new files, of which the driver reads the header line; the batch reader reads the rest.
    """
    # Names alone: of a binary file whose content is not asked for, nothing is read.
    files = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", FILES_PER_BATCH).load(raw_folder)
    located = files.select("_metadata.file_path")

    def store(batch: DataFrame, batch_id: int) -> None:
        headers: dict[str, list[str]] = {}
        for path in sorted(unquote(r.file_path) for r in batch.collect()):
            header = first_line(spark, path)
            if header is not None:
                headers.setdefault(header, []).append(path)
        if headers:
            raw = read_files_by_name(spark, headers, table)
            split = counted_split(raw, table)
            changes = reduced(split.rows, table, datetime_formats)
            changes.write.options(**COMPACT_PARQUET).mode("overwrite").parquet(f"{state_folder}/changes/batch_id={batch_id}")
            if split.tally.get["rejected"]:
                rejected_cells(raw, table).write.mode("overwrite").parquet(f"{state_folder}/rejected/batch_id={batch_id}")

    query = (
        located.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{state_folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def compact(spark: SparkSession, table: str, state_folder: str, upto: int | None = None) -> None:
    """Write the current rows, or those as of batch ``upto``, as the new base; a call that fails leaves the old one in force.

    Facts refreshed from the state ask for the versions as of the batch they have seen: compact up to that batch,
    or keep what the base covers until the next refresh.
    """
    last = last_batch(spark, state_folder)
    upto = last if upto is None else min(upto, last)
    if upto in whole_parts(spark, f"{state_folder}/base", "upto"):
        # It holds those rows already; to write it again would read what it overwrites.
        return
    stored = stored_rows(spark, table, state_folder, upto)
    rows = stored.drop("batch_id") if is_reduced(spark, table, state_folder, upto) else reduced_again(stored, table)
    rows.write.options(**COMPACT_PARQUET).mode("overwrite").parquet(f"{state_folder}/base/upto={upto}")


def changed_keys(spark: SparkSession, table: str, state_folder: str, after_batch: int = -1) -> DataFrame:
    """Distinct business keys stored after batch ``after_batch``; only those batches are read."""
    return stored_changes(spark, table, state_folder, after_batch).select(VERSIONED[table][1]).distinct()
