"""Raw inputs: text columns by name, missing-value tokens as NULL, and the order of arrival."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import null_tokens
from ledgerloom.schema import INGEST_ORDINAL, OPTIONAL_COLUMNS, RAW_COLUMNS
from ledgerloom.sources.manifest import file_system
from ledgerloom.sources.quoted import read_quoted


def csv_reader_options(multi_line: bool = True) -> dict[str, str]:
    """Headered CSV with doubled quotes; a header that differs between files raises an error.

    With ``multi_line`` a quoted cell may hold line breaks, and each file is read by one task; without it large
    files are split.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
    }


def with_arrival_order(scan: DataFrame) -> DataFrame:
    """Add the arrival ordinal to a file scan: newer file, then path, then position in the file.

    The row id only orders rows of one split, where it follows file order; the block start
    orders the splits of a file.
    """
    ordinal = F.struct(
        F.col("_metadata.file_modification_time"),
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.select("*", ordinal.alias(INGEST_ORDINAL))


def conform_raw(df: DataFrame, table: str) -> DataFrame:
    """Raw ``table`` columns as text with missing-value tokens nulled; the ordinal is kept if present.

    Columns are matched by name. Unknown columns are dropped, a missing one raises ``ValueError``.
    """
    missing = [name for name in RAW_COLUMNS[table] if name not in df.columns]
    if missing:
        raise ValueError(f"raw table {table} lacks columns {missing}")
    optional = [name for name in OPTIONAL_COLUMNS.get(table, ()) if name in df.columns]
    cells = [null_tokens(name) for name in (*RAW_COLUMNS[table], *optional)]
    ordinal = [INGEST_ORDINAL] if INGEST_ORDINAL in df.columns else []
    return df.select(*cells, *ordinal)


def large_files(spark: SparkSession, paths: str | list[str]) -> bool:
    """Whether a file is larger than a split, so that one task per file would be too much for it."""
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    for path in [paths] if isinstance(paths, str) else paths:
        files, place = file_system(spark, path)
        # Globs and missing folders are left to the reader.
        found = files.globStatus(place) or []
        for status in found:
            inner = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            if any(f.getLen() > limit for f in inner):
                return True
    return False


def first_line(spark: SparkSession, path: str) -> str | None:
    """The header line of a file, compressed or not; None if the file is empty. No more than a buffer of it is read."""
    jvm = spark._jvm
    files, place = file_system(spark, path)
    if not files.getFileStatus(place).getLen():
        return None
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
    stream = files.open(place)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def read_raw_csv(
    spark: SparkSession, path: str | list[str], table: str, multi_line: bool = True
) -> DataFrame:
    """Raw ``table`` from one CSV file, a folder or a list of them.

    With ``multi_line`` a quoted cell may hold line breaks. Files up to the size of a split are then read by one task
    each; if one is larger, all are split into lines and put together by :mod:`ledgerloom.sources.quoted`, which also
    matches each file by its own header. Without it Spark splits the files, and no cell may hold a line break.
    """
    if multi_line and large_files(spark, path):
        parts = read_quoted(spark, path, csv_reader_options())
        if parts is not None:
            tables = [conform_raw(rows.withColumn(INGEST_ORDINAL, order).drop("_arrival"), table) for rows, order in parts]
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
        multi_line = False
    scan = spark.read.options(**csv_reader_options(multi_line)).csv(path)
    return conform_raw(with_arrival_order(scan), table)


def load_raw(spark: SparkSession, raw_folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """All raw tables of ``raw_folder``, each a ``<table>.csv`` file or folder."""
    return {table: read_raw_csv(spark, f"{raw_folder}/{table}.csv", table, multi_line) for table in RAW_COLUMNS}
