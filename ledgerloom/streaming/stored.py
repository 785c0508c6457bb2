"""What ingest has stored of a raw table: reduced batches, and bases that hold the batches up to one.

State of a table below its folder: ``progress`` (of the stream), ``changes/batch_id=N``, ``base/upto=N``. A batch or
base counts once it is whole. Rows can be asked for as of an earlier batch: the newest base up to it, and the batches
between.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import dedup_latest, require_keys, require_parsed_keys, require_parsed_text
from ledgerloom.plans import staging
from ledgerloom.schema import INGEST_ORDINAL, OPTIONAL_COLUMNS, RAW_COLUMNS
from ledgerloom.sources import conform_raw
from ledgerloom.sources.manifest import exists, names_in

# Raw table with versions -> (typed projection, business key, filter for the key, columns checked after dedup).
# Of the other tables every distinct line, or every event, counts.
VERSIONED: dict[str, tuple[Callable[..., DataFrame], str, Callable[..., DataFrame], tuple[str, ...]]] = {
    "orders_master": (staging.typed_orders, "order_id", require_parsed_keys, ("customer_id",)),
    "payments": (staging.typed_payments, "payment_id", require_parsed_keys, ("order_id",)),
    "customers": (staging.typed_customers, "customer_id", require_parsed_keys, ()),
    "customer_cards": (staging.typed_customer_cards, "card_id", require_parsed_text, ("customer_id",)),
    "products": (lambda raw, _: staging.typed_products(raw), "product_id", require_parsed_text, ()),
}


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Last row per key by ``order``, which is kept."""
    return dedup_latest(rows.withColumn("_order", F.struct(*order)), key, "_order")


def reduced(raw: DataFrame, table: str, datetime_formats: Sequence[str]) -> DataFrame:
    """Typed rows of a batch, versions reduced to the last per key, with the ordinal kept."""
    if table == "order_details":
        # Lines of several batches are made distinct on reading in any case; copies within one are left to that.
        return staging.keyed_order_details(raw)
    if table not in VERSIONED:
        return staging.BUILDERS[f"stg_{table}"][1](raw, datetime_formats)
    typed, key, require_key, _ = VERSIONED[table]
    return latest(require_key(typed(raw, datetime_formats), key), key, INGEST_ORDINAL)


SCHEMAS: dict[str, T.StructType] = {}


def stored_schema(spark: SparkSession, table: str) -> T.StructType:
    """Columns of a stored batch, the optional ones among them; given to every read, so that none has to infer it."""
    if table not in SCHEMAS:
        ordinal = "struct<file_modification_time: timestamp, file_path: string, file_block_start: bigint, row: bigint>"
        columns = (*RAW_COLUMNS[table], *OPTIONAL_COLUMNS.get(table, ()))
        raw = spark.createDataFrame([], ", ".join([*(f"{c} string" for c in columns), f"{INGEST_ORDINAL} {ordinal}"]))
        fields = reduced(conform_raw(raw, table), table, ()).schema.fields
        SCHEMAS[table] = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return SCHEMAS[table]


def whole_parts(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the ``name=N`` folders that were written to the end, ascending; listed, not read."""
    found = [n.removeprefix(f"{name}=") for n in names_in(spark, folder) if n.startswith(f"{name}=")]
    return sorted(int(n) for n in found if exists(spark, f"{folder}/{name}={n}/_SUCCESS"))


def last_batch(spark: SparkSession, state_folder: str) -> int:
    """The newest stored batch, -1 if there is none."""
    return max(whole_parts(spark, f"{state_folder}/changes", "batch_id"), default=-1)


def stored_changes(
    spark: SparkSession, table: str, state_folder: str, after_batch: int = -1, upto: int | None = None
) -> DataFrame:
    """Stored rows of the batches after ``after_batch`` up to ``upto`` with their ``batch_id``; only those are read."""
    folder = f"{state_folder}/changes"
    batches = [n for n in whole_parts(spark, folder, "batch_id") if n > after_batch and (upto is None or n <= upto)]
    fields = T.StructType([*stored_schema(spark, table).fields, T.StructField("batch_id", T.IntegerType())])
    if not batches:
        return spark.createDataFrame([], fields)
    paths = [f"{folder}/batch_id={n}" for n in batches]
    return spark.read.schema(fields).option("basePath", folder).parquet(*paths)


def stored_rows(spark: SparkSession, table: str, state_folder: str, upto: int | None = None) -> DataFrame:
    """All stored rows, those of a base as batch -1; as of batch ``upto`` if given."""
    folder = f"{state_folder}/base"
    base = max((n for n in whole_parts(spark, folder, "upto") if upto is None or n <= upto), default=None)
    if base is None:
        return stored_changes(spark, table, state_folder, upto=upto)
    kept = spark.read.schema(stored_schema(spark, table)).parquet(f"{folder}/upto={base}").withColumn("batch_id", F.lit(-1))
    return kept.unionByName(stored_changes(spark, table, state_folder, base, upto))


def reduced_again(rows: DataFrame, table: str) -> DataFrame:
    """Stored rows reduced once more, ordinals kept.

    A batch holds a key once, so the batch alone tells versions apart; ordinals, which name files, need not move.
    """
    if table in VERSIONED:
        return latest(rows, VERSIONED[table][1], "batch_id").drop("batch_id")
    rows = rows.drop("batch_id")
    return staging.distinct_lines(rows) if table == "order_details" else rows


def is_reduced(spark: SparkSession, table: str, state_folder: str, upto: int | None = None) -> bool:
    """Whether the stored rows hold each key once already: versions all of one batch, or of one base."""
    bases = [n for n in whole_parts(spark, f"{state_folder}/base", "upto") if upto is None or n <= upto]
    after = max(bases, default=-1)
    batches = [n for n in whole_parts(spark, f"{state_folder}/changes", "batch_id") if n > after and (upto is None or n <= upto)]
    return table in VERSIONED and bool(bases) + len(batches) <= 1


def staged(rows: DataFrame, table: str, unique: bool = False) -> DataFrame:
    """The staging table that stored rows make; ``unique`` says that they hold each key once."""
    current = (rows.drop("batch_id") if unique else reduced_again(rows, table)).drop(INGEST_ORDINAL)
    required = VERSIONED[table][3] if table in VERSIONED else ()
    return require_keys(current, *required) if required else current


def current_table(spark: SparkSession, table: str, state_folder: str, upto: int | None = None) -> DataFrame:
    """The staging table as of the last stored batch, or of ``upto``."""
    rows = stored_rows(spark, table, state_folder, upto)
    return staged(rows, table, is_reduced(spark, table, state_folder, upto))


def versions_of(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The stored rows of the ``keys``, so that only those are reduced.

    Keys may come twice; to make them distinct takes a shuffle more, so that is left to callers whose keys come often.
    """
    return rows.join(keys.select(key), key, "left_semi").select(*rows.columns)
