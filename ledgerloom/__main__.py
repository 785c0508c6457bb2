"""``spark-submit``/``python -m ledgerloom RAW_FOLDER OUT_FOLDER``: run every layer and show the outcome.

``--datetime-format`` may be repeated; ``--single-line`` splits large files whose cells hold no line breaks;
``--most-rejected`` is the share of a table's rows that may hold a number that does not fit.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerloom.plans import run, run_summary
from ledgerloom.plans.rejects import MOST_REJECTED


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    parser.add_argument("raw_folder")
    parser.add_argument("out_folder")
    parser.add_argument("--datetime-format", action="append", default=[])
    parser.add_argument("--single-line", action="store_true")
    parser.add_argument("--most-rejected", type=float, default=MOST_REJECTED)
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("ledgerloom").getOrCreate()
    layers = run(
        spark, options.raw_folder, options.out_folder, options.datetime_format, not options.single_line, options.most_rejected
    )
    run_summary(spark, layers).show(100, truncate=False)
    layers.data_quality["data_quality_report"].show(truncate=False)
    layers.analytics["kpi_summary"].show(truncate=False)


if __name__ == "__main__":
    main()
