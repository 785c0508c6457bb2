"""Large CSV files whose quoted cells may hold line breaks, read by many tasks.

Spark's multi-line reader takes one task per file. Here Spark's text reader splits the files into lines. A line with an
odd number of quotes opens or closes a cell that goes over its end, so whether a line begins a record follows from the
number of such lines before it in its file: a running count within the split, and a prefix sum over the splits of the
file, one row each. Only lines of records that do span lines are brought together, by record; the others stay where
they are. Spark's own ``from_csv`` parses the records.

Records end with a line feed (and a carriage return before it, if any). A quote stands around a cell or, doubled, in one
that is quoted. A quote that is never closed makes the rest of its file one record, as with the multi-line reader.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.sources.tables import work_folder

# Different header lines of one table: each is a plan of its own.
MOST_HEADERS = 50

# Fixed value: the byte order mark that a file may begin with.
MARK = "\ufeff"


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their place: time and path of the file, start of the split, and a number that ascends within it."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value",
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    ).withColumn("odd", F.col("quotes") % 2 == 1).drop("quotes")


def split_summary(lines: DataFrame) -> DataFrame:
    """One row per split: lines that open or close a record, how many of them the file has before the split (``open``:
    an odd number), the last line that begins a record in an earlier split, and the file's header."""
    first_line = F.when(F.col("block") == 0, F.struct("row", "value"))
    splits = lines.groupBy("path", "block").agg(
        F.count_if("odd").alias("odd_lines"), F.min(first_line).alias("first"), F.max("row").alias("last_row")
    )
    in_file = Window.partitionBy("path").orderBy("block")
    earlier = F.coalesce(F.sum("odd_lines").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    header = F.first("first", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    return splits.select(
        "path",
        "block",
        "odd_lines",
        (earlier % 2 == 1).alias("open"),
        header["value"].alias("header"),
        F.when(F.col("block") == 0, header["row"]).alias("header_row"),
    )


def begun(lines: DataFrame) -> DataFrame:
    """Lines of splits with spanning records, with ``begins`` and the last beginning in the split at or before the line."""
    in_split = Window.partitionBy("path", "block").orderBy("row")
    before = F.coalesce(F.count_if("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (before + F.col("open").cast("int")) % 2 == 0
    marked = lines.withColumn("begins", begins)
    start = F.when(F.col("begins"), F.struct("block", "row"))
    return marked.withColumn("start", F.last(start, ignorenulls=True).over(in_split.rowsBetween(Window.unboundedPreceding, 0)))


def records_of(spark: SparkSession, lines: DataFrame, splits: DataFrame) -> DataFrame:
    """``(header, value, time, path, block, row)`` per record, at the place of its first line; headers left out."""
    tagged = lines.join(splits, ["path", "block"])
    spanning = (F.col("odd_lines") > 0) | F.col("open")
    # Written once: the windows and the grouping below read it in several places.
    folder = work_folder(spark, "quoted")
    begun(tagged.where(spanning)).write.parquet(folder)
    mixed = spark.read.parquet(folder)

    # What goes on from earlier splits belongs to the last record that began in one of them.
    last = mixed.groupBy("path", "block").agg(F.max_by("start", "row").alias("last_start"))
    quiet = tagged.where(~spanning).groupBy("path", "block").agg(F.max(F.struct("block", "row")).alias("last_start"))
    in_file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.union(quiet).select("path", "block", F.last("last_start", ignorenulls=True).over(in_file).alias("carried"))

    place = ["time", "path", "block", "row"]
    not_header = F.col("header_row").isNull() | (F.col("row") != F.col("header_row"))
    whole = tagged.where(~spanning & not_header).select("header", "value", *place)
    alone = mixed.where(F.col("begins") & ~F.col("odd") & not_header).select("header", "value", *place)
    pieces = (
        mixed.where(~F.col("begins") | F.col("odd"))
        .join(carried, ["path", "block"])
        .withColumn("start", F.coalesce("start", "carried"))
        .groupBy("time", "path", "start", "header")
        .agg(F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("lines"))
        .select(
            "header", F.array_join(F.col("lines.value"), "\n").alias("value"), "time", "path",
            F.col("start.block").alias("block"), F.col("start.row").alias("row"),
        )
    )
    records = reduce(DataFrame.union, (whole, alone, pieces))
    # A blank line is no record.
    return records.withColumn("value", F.regexp_replace("value", "\r$", "")).where("value <> ''")


def column_names(spark: SparkSession, header: str, options: dict[str, str]) -> list[str]:
    """The names in a header line, as Spark's parser reads them."""
    width = header.count(",") + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    row = spark.createDataFrame([(header,)], "header string").select(F.from_csv("header", schema, options).alias("n")).first().n
    return [name for name in row if name is not None]


def read_quoted(
    spark: SparkSession, paths: str | list[str], options: dict[str, str]
) -> list[tuple[DataFrame, Column]] | None:
    """The rows of CSV files, per different header line, with a column expression of their order of arrival.

    ``None`` if no cell goes over the end of its line, so that Spark's reader can split the files itself.
    """
    lines = lines_of(spark, paths)
    folder = work_folder(spark, "splits")
    split_summary(lines).write.parquet(folder)
    splits = spark.read.parquet(folder)
    if splits.where("odd_lines > 0").isEmpty():
        return None
    headers = [r.header for r in splits.select("header").distinct().orderBy("header").limit(MOST_HEADERS + 1).collect()]
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"{paths}: more than {MOST_HEADERS} different header lines")
    records = records_of(spark, lines, splits)
    read = {"multiLine": "true", **{k: v for k, v in options.items() if k in ("quote", "escape")}}
    found = []
    for header in headers:
        names = column_names(spark, header.removeprefix(MARK).removesuffix("\r"), read)
        schema = ", ".join(f"`{n}` string" for n in names)
        own = records if len(headers) == 1 else records.where(F.col("header") == header)
        if header.endswith("\r"):
            # Where lines end so, a break within a cell is one as well and reads as a line feed.
            own = own.withColumn("value", F.replace("value", F.lit("\r\n"), F.lit("\n")))
        parsed = own.select(F.from_csv("value", schema, read).alias("cells"), "time", "path", "block", "row")
        arrival = F.struct("time", "path", "block", "row")
        found.append((parsed.select("cells.*", arrival.alias("_arrival")), F.col("_arrival")))
    return found
