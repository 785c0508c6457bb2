"""Run registered queries in Spark and their SQL in DuckDB and compare rows.

Usage: python -m ledgerloom_checks.compare [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from ledgerloom_checks import oracle, registry

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerloom")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def duck_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row[name] for name in names) for row in df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides hold the same columns and the same rows, else what differs."""
    names, expected = duck_rows(con, sql)
    if names != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {names}"
    actual = spark_rows(df)
    if actual == expected:
        return "" if actual else "no rows on either side"
    extra, missing = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return f"{actual.total()} rows != {expected.total()}; only Spark {extra}; only SQL {missing}"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con = local_session(), duck_tables(sf_dir)
    queries, sql = registry.queries(), oracle.oracle_sql()
    failures = 0
    for name in names or queries:
        start = time.time()
        if name in sql:
            difference = compare(queries[name](spark, sf_dir), con, sql[name])
            state = "ok" if not difference else f"DIFFERS {difference}"
            failures += bool(difference)
        else:
            state = f"rows only: {queries[name](spark, sf_dir).count()}"
        print(f"{name:50s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{failures} differ")
    return failures


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
