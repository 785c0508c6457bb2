from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerloom-tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def column(spark, expression, cells):
    """Evaluate an expression builder over text cells in a column named ``c``, in order."""
    rows = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    return [r.v for r in rows.select("i", expression("c").alias("v")).orderBy("i").collect()]


def raw_frame(spark, table, rows):
    """A conformed raw table from tuples in arrival order."""
    from ledgerloom.schema import INGEST_ORDINAL, RAW_COLUMNS
    from ledgerloom.sources import conform_raw

    names = RAW_COLUMNS[table]
    schema = ", ".join(f"{name} string" for name in names) + f", {INGEST_ORDINAL} bigint"
    return conform_raw(spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], schema), table)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
