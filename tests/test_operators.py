from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest
from conftest import plan_text
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.tiers import tier_blocks
from ledgerloom.operators import (
    dedup_exact,
    dedup_latest,
    duplicate_rows,
    fk_violations,
    frequent_keys,
    latest_value,
    require_keys,
    spread_join,
    tier_lookup,
)


def test_keep_last_follows_the_ordinal_not_the_partitioning(spark):
    rows = [(k, f"v{i}", i) for i, k in enumerate([1, 2, 1, 3, 2, 1])]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, v string, _ingest_seq bigint").repartition(5)
    assert sorted(map(tuple, dedup_latest(df, "k").collect())) == [(1, "v5"), (2, "v4"), (3, "v3")]


def test_keep_last_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS _ingest_seq")
    text = plan_text(dedup_latest(df, "k"))
    partial, exchange = text.rindex("WindowGroupLimit"), text.rindex("Exchange hashpartitioning")
    assert partial > exchange, text


def test_last_copy_decides_before_the_key_filter(spark):
    df = spark.createDataFrame([(1, 10, 0), (1, None, 1), (2, 20, 2)], "k bigint, owner bigint, _ingest_seq bigint")
    assert [tuple(r) for r in require_keys(dedup_latest(df, "k"), "owner").collect()] == [(2, 20)]


def test_exact_dedup_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, 2), (2, 2)], "a int, b int")
    assert Counter(map(tuple, dedup_exact(df, ["a", "b"]).collect())) == Counter([(1, None), (1, 2), (2, 2)])


def test_duplicate_rows_counts_all_copies_and_ignores_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert duplicate_rows(df, "k", "n").first().n == 2
    assert duplicate_rows(df.where("k = 2"), "k", "n").first().n == 0


def test_fk_violations_count_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parents = spark.createDataFrame([(1,), (None,)], "k int")
    assert fk_violations(df, "k", parents, "n").first().n == 3


def test_unknown_time_is_latest_and_null_values_are_skipped(spark):
    rows = [
        (1, "2026-01-01", 1, "failed"), (1, "2026-01-02", 2, "success"),
        (2, None, 5, "pending"), (2, "2026-01-09", 6, "success"),
        (3, "2026-01-01", 7, "failed"), (3, "2026-01-01", 8, "success"),
        (4, "2026-01-01", 9, "failed"), (4, "2026-01-02", 10, None),
        (5, "2026-01-01", 11, None),
    ]
    df = spark.createDataFrame(rows, "k int, t string, id int, s string").withColumn("t", F.to_date("t"))
    latest = df.groupBy("k").agg(latest_value(F.col("s"), F.col("t"), F.col("id")).alias("s"))
    assert dict(map(tuple, latest.collect())) == {1: "success", 2: "pending", 3: "success", 4: "failed", 5: None}


TIERS = [("0", "49.99", "1"), ("50", "99.99", "3"), ("100", "199.99", "8"), ("200", "499.99", "20"), ("1000", None, "120")]


def tier_frame(spark, tiers):
    schema = "min_amount string, max_amount string, points_awarded string"
    return spark.createDataFrame(tiers, schema).select(
        *(F.col(c).cast("decimal(18,4)") for c in ("min_amount", "max_amount", "points_awarded"))
    )


def looked_up(spark, amounts, tiers):
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "i int, a string")
    rows = rows.select("i", F.col("a").cast("decimal(38,13)").alias("a"))
    result = tier_lookup(rows, "a", tier_frame(spark, tiers))
    return [r.points_delta for r in result.orderBy("i").collect()]


def test_tiers_are_closed_with_gaps_and_an_open_top(spark):
    amounts = ["49.99", "49.995", "50", "1000000", None, "-1", "600", "1000"]
    assert looked_up(spark, amounts, TIERS) == [1, 0, 3, 120, 0, 0, 0, 120]


def test_overlapping_tiers_give_the_highest_lower_bound(spark):
    tiers = [("0", None, "1"), ("10", "30", "2"), ("20", "25", "3")]
    assert looked_up(spark, ["5", "15", "22", "27", "31"], tiers) == [1, 2, 3, 2, 1]


def test_no_tiers_give_no_points(spark):
    assert looked_up(spark, ["5", None], []) == [0, 0]


BOUND = st.integers(0, 400)


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(BOUND, st.one_of(st.none(), BOUND), st.integers(0, 50)), min_size=1, max_size=12),
    st.lists(st.integers(-10, 500), min_size=1, max_size=60),
)
def test_tiers_match_brute_force(spark, tiers, amounts):
    by_low = {low: (low, high, points) for low, high, points in tiers}  # distinct lower bounds: no ties
    tiers = list(by_low.values())

    def brute(a):
        matches = [t for t in tiers if t[0] <= a and (t[1] is None or a <= t[1])]
        return max(matches)[2] if matches else 0

    text = [(str(low), None if high is None else str(high), str(points)) for low, high, points in tiers]
    expected = [Decimal(brute(a)) for a in amounts]
    assert looked_up(spark, [str(a) for a in amounts], text) == expected


def test_thousands_of_open_far_and_nested_tiers(spark):
    rng = random.Random(4)
    tiers = [(i, None if i % 3 else rng.choice([i, i + 5, 10**13]), i % 97) for i in range(0, 6000, 2)]
    amounts = [Decimal(rng.randint(-100, 130_000)) / 16 for _ in range(300)] + [Decimal(10) ** 20, Decimal(-10) ** 19]
    frame = tier_frame(spark, [(str(a), None if b is None else str(b), str(c)) for a, b, c in tiers])
    # Rows grow with tiers times block sizes, not with pairs of tiers.
    assert tier_blocks(frame).count() < 40 * len(tiers)
    got = looked_up(spark, [str(a) for a in amounts], [(str(a), None if b is None else str(b), str(c)) for a, b, c in tiers])
    for a, points in zip(amounts, got, strict=True):
        matches = [t for t in tiers if t[0] <= a and (t[1] is None or a <= t[1])]
        assert points == (max(matches, key=lambda t: t[0])[2] if matches else 0), a


def test_blocks_tile_each_tier_exactly(spark):
    bounds = [("0", "0"), ("-5", "7.0001"), ("1", None), ("-99999999999999", "99999999999999.9999")]
    for low, high in bounds:
        frame = tier_frame(spark, [(low, high, "1")])
        pieces = sorted((r.block.number << r.block.size, (r.block.number + 1) << r.block.size) for r in tier_blocks(frame).collect())
        half = 1 << 61
        assert pieces[0][0] == 2 * int(Decimal(low) * 10000) + half
        assert pieces[-1][1] == (1 << 62) + 1 if high is None else pieces[-1][1] == 2 * int(Decimal(high) * 10000) + half + 1
        assert all(a[1] == b[0] for a, b in zip(pieces, pieces[1:], strict=False))


def hot_facts(spark):
    """A third of the facts carry key 7, a few carry none, the rest are spread evenly."""
    return spark.range(6000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 500 END AS k"
    )


def test_frequent_keys_find_only_the_hot_key(spark):
    found = frequent_keys(hot_facts(spark), "k").collect()
    assert [(r.k, r._fan) for r in found] == [(7, 3)]
    assert frequent_keys(hot_facts(spark).where("false"), "k").collect() == []


def test_every_hot_key_is_listed(spark):
    """600 keys above one share of 2000 partitions, and none of the others."""
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        facts = spark.range(600 * 40).selectExpr("id % 600 AS k").union(spark.range(12000).selectExpr("id + 1000 AS k"))
        found = frequent_keys(facts.repartition(4), "k")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = found.collect()
    assert sorted(r.k for r in rows) == list(range(600)) and {r._fan for r in rows} == {3}
    assert "sketch" not in plan and "Limit" not in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_returns_what_a_plain_join_returns(spark, how):
    facts = hot_facts(spark)
    lookup = spark.range(0, 400).selectExpr("id AS k", "id * 2 AS v")
    lookup = lookup.union(spark.createDataFrame([(7, -1)], "k bigint, v bigint"))  # two rows for the hot key
    spread = spread_join(facts, lookup, "k", frequent_keys(facts, "k"), ["id"], how)
    plain = facts.join(lookup, "k", how)
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


def test_spread_join_splits_the_hot_key_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = hot_facts(spark)
        lookup = spark.range(0, 500).selectExpr("id AS k", "id AS v")

        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

        plain = largest(facts.join(lookup, "k", "left"))
        spread = largest(spread_join(facts, lookup, "k", frequent_keys(facts, "k"), ["id"]))
        assert plain > 2000 and spread < 1700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_copies_of_one_row_split_too(spark):
    copies = spark.range(0, 4000, 1, 16).selectExpr("1L AS id", "7L AS k")
    lookup = spark.range(10).selectExpr("id AS k", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(copies, lookup, "k", frequent_keys(copies, "k"), ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
