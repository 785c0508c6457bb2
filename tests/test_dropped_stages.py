"""The cost of a write when the status store has dropped stages of its jobs."""

from __future__ import annotations

from ledgerloom.sources import metrics


def test_a_stage_that_the_store_has_dropped_costs_nothing(spark):
    assert metrics._stage(spark._jsc.sc().statusStore(), 10**9) is None


def test_the_cost_of_a_group_leaves_dropped_stages_out(spark, monkeypatch):
    spark.sparkContext.setJobGroup("dropped-stages", "two stages")
    try:
        spark.range(100, numPartitions=3).groupBy("id").count().count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    whole = metrics.group_cost(spark, "dropped-stages")
    assert whole.tasks > 3
    found, first = metrics._stage, []

    def dropped(store, number):
        first.append(number)
        return found(store, 10**9 if number == first[0] else number)

    monkeypatch.setattr(metrics, "_stage", dropped)
    assert 0 < metrics.group_cost(spark, "dropped-stages").tasks < whole.tasks
