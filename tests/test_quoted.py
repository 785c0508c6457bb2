"""Large CSV files with quoted line breaks: split over tasks, equal to the multi-line reader."""

from __future__ import annotations

import csv
import random
from collections import Counter
from contextlib import contextmanager

import pytest

from ledgerloom.plans.staging import build_staging
from ledgerloom.schema import INGEST_ORDINAL, RAW_COLUMNS
from ledgerloom.sources import quoted, raw, read_raw_csv

COLUMNS = RAW_COLUMNS["customers"]


@contextmanager
def splits_of(spark, size):
    """Files are cut into splits of so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def random_cell(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(["", "plain", " spaced ", "é漢", "0"])
    return "".join(rng.choice(['a', 'b', ",", '"', "\n", "\r\n", " ", "é"]) for _ in range(rng.randrange(8)))


def write_random(path, rng, rows, end="\r\n", names=COLUMNS):
    cells = []
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(names)
        for i in range(rows):
            row = [str(i), *(random_cell(rng) for _ in names[1:])]
            out.writerow(row)
            cells.append(row)
    return cells


def cells_of(df):
    return [tuple(r)[: len(COLUMNS)] for r in df.orderBy(INGEST_ORDINAL).collect()]


@pytest.mark.parametrize(("end", "size"), [("\n", 150), ("\r\n", 400), ("\n", 37)])
def test_random_files_equal_the_multi_line_reader(spark, tmp_path, end, size):
    rng = random.Random(size)
    path = str(tmp_path / "customers.csv")
    write_random(path, rng, 120, end)
    whole = cells_of(read_raw_csv(spark, path, "customers"))
    with splits_of(spark, size):
        parts = quoted.read_quoted(spark, path, raw.csv_reader_options())
        assert parts is not None and quoted.lines_of(spark, path).rdd.getNumPartitions() > 10
        split = read_raw_csv(spark, path, "customers")
        assert cells_of(split) == whole
    assert len(whole) == 120


def test_a_record_longer_than_several_splits(spark, tmp_path):
    path = tmp_path / "customers.csv"
    long = "x\n" * 300
    path.write_text(f'{",".join(COLUMNS)}\n1,a,b,c,d,e\n2,"{long}",b,c,d,e\n\n3,f,g,h,i,j\n', encoding="utf-8")
    with splits_of(spark, 64):
        rows = cells_of(read_raw_csv(spark, str(path), "customers"))
    assert [r[0] for r in rows] == ["1", "2", "3"] and rows[1][1] == long


def test_files_without_line_breaks_are_left_to_the_reader(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(f'{",".join(COLUMNS)}\n' + "".join(f'{i},"a ""b""",c,d,e,f\n' for i in range(50)), encoding="utf-8")
    with splits_of(spark, 128):
        assert quoted.read_quoted(spark, str(path), raw.csv_reader_options()) is None
        df = read_raw_csv(spark, str(path), "customers")
        assert df.rdd.getNumPartitions() > 3
        assert [(r[0], r[1]) for r in cells_of(df)] == [(str(i), 'a "b"') for i in range(50)]


def test_small_files_take_one_task_each(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(f'{",".join(COLUMNS)}\n1,"a\nb",c,d,e,f\n', encoding="utf-8")
    assert not raw.large_files(spark, str(path))
    assert cells_of(read_raw_csv(spark, str(path), "customers"))[0][1] == "a\nb"


def test_several_files_with_headers_in_another_order(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    rng = random.Random(4)
    first = write_random(folder / "a.csv", rng, 40, "\n")
    second = write_random(folder / "b.csv", rng, 30, "\n", COLUMNS[::-1])
    expected = Counter(c[0] for c in first) + Counter(c[-1] for c in second)
    with splits_of(spark, 200):
        rows = cells_of(read_raw_csv(spark, str(folder), "customers"))
    # A missing-value token reads as null.
    assert Counter(r[0] or "" for r in rows) == Counter({k or "": n for k, n in expected.items()})


def test_the_last_copy_wins_across_splits(spark, tmp_path):
    path = tmp_path / "customers.csv"
    body = "".join(f'{i % 7},"n{i}\nx",s{i},c,d,e\n' for i in range(200))
    path.write_text(f'{",".join(COLUMNS)}\n{body}', encoding="utf-8")
    with splits_of(spark, 256):
        staged = build_staging({"customers": read_raw_csv(spark, str(path), "customers")})["stg_customers"].collect()
    last = {i % 7: f"S{i}" for i in range(200)}
    assert {r.customer_id: r.segment for r in staged} == last
