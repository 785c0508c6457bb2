"""What a write cost: time, rows, bytes and tasks of the jobs of one job group, as Spark's status store counted them."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Cost(NamedTuple):
    """Of all stages of the jobs; the longest and the median task are those of the stage with the longest one."""

    tasks: int = 0
    task_seconds: float = 0.0
    bytes_read: int = 0
    bytes_written: int = 0
    bytes_shuffled: int = 0
    bytes_spilled: int = 0
    longest_task_seconds: float = 0.0
    median_task_seconds: float = 0.0


SCHEMA = (
    "layer string, table_name string, seconds double, rows bigint, tasks bigint, task_seconds double, bytes_read bigint, "
    "bytes_written bigint, bytes_shuffled bigint, bytes_spilled bigint, longest_task_seconds double, median_task_seconds double"
)


def _each(sequence):
    return [sequence.apply(i) for i in range(sequence.size())]


def _stage(store, number: int):
    """The last attempt of a stage; none if the store has dropped it, as it does with skipped stages first."""
    try:
        return store.lastStageAttempt(number)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.util.NoSuchElementException":
            raise
        return None


def group_cost(spark: SparkSession, group: str) -> Cost:
    """The cost of the finished jobs of a group; stages that were skipped, as their output was there, cost nothing."""
    context = spark._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    store = context.statusStore()
    jobs = [job for job in _each(store.jobsList(None)) if job.jobGroup().isDefined() and job.jobGroup().get() == group]
    stages = [_stage(store, n) for n in sorted({n for job in jobs for n in _each(job.stageIds())})]
    stages = [stage for stage in stages if stage and stage.numCompleteTasks()]
    ends = spark._sc._gateway.new_array(spark._jvm.double, 2)
    ends[0], ends[1] = 0.5, 1.0
    longest = (0.0, 0.0)
    for stage in stages:
        summary = store.taskSummary(stage.stageId(), stage.attemptId(), ends)
        if summary.isDefined():
            median, most = _each(summary.get().executorRunTime())
            longest = max(longest, (most / 1000, median / 1000))
    return Cost(
        sum(s.numCompleteTasks() for s in stages),
        sum(s.executorRunTime() for s in stages) / 1000,
        sum(s.inputBytes() for s in stages),
        sum(s.outputBytes() for s in stages),
        sum(s.shuffleWriteBytes() for s in stages),
        sum(s.diskBytesSpilled() for s in stages),
        *longest,
    )
