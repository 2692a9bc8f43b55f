"""Run metrics, comparison of runs, and how the data lies in partitions."""

from __future__ import annotations

import time
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from plaudit.functions import presets
from plaudit.functions.text import seconds_label
from plaudit.sources.readers import in_memory


def sentiment_measures() -> list[Column]:
    """Rows, rows per category and mean polarity: all from one pass."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("avg_sentiment"),
        *[F.count_if(F.col("category") == name).alias(f"{name}_count") for name in presets.CATEGORIES],
    ]


def run_metrics(scored: DataFrame) -> DataFrame:
    """The data measures of a run as one row."""
    return scored.agg(*sentiment_measures())


def observed(df: DataFrame, name: str, measures: list[Column]) -> tuple[DataFrame, Observation]:
    """Measures that fill in while ``df`` is written, without a second pass."""
    observation = Observation(name)
    return df.observe(observation, *measures), observation


TASK_SCHEMA = (
    "task string, seconds double, task_seconds double, tasks bigint, input_rows bigint, input_bytes bigint, "
    "shuffle_bytes bigint, output_rows bigint, output_bytes bigint"
)


class TaskTimes:
    """What the jobs of a run's tasks took and moved, from Spark's own stage metrics.

    A task may be entered several times; its jobs are known by their job group. ``seconds`` is the time
    that passed, ``task_seconds`` the time of all executor threads: lazy plans are charged where they run.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.run = spark, uuid.uuid4().hex[:12]
        self.passed: dict[str, float] = defaultdict(float)

    @contextmanager
    def task(self, name: str) -> Iterator[None]:
        context = self.spark.sparkContext
        names = ("spark.jobGroup.id", "spark.job.description")
        before = [context.getLocalProperty(key) for key in names]
        context.setJobGroup(f"{self.run} {name}", name)
        begun = time.perf_counter()
        try:
            yield
        finally:
            self.passed[name] += time.perf_counter() - begun
            for key, value in zip(names, before):
                context.setLocalProperty(key, value)

    def table(self) -> DataFrame:
        """One row per task, in the order in which they were first entered."""
        context = self.spark.sparkContext
        core = context._jsc.sc()
        core.listenerBus().waitUntilEmpty(10_000)  # the last stage's metrics may still be on their way
        store, jobs = core.statusStore(), context.statusTracker()
        listed = store.stageList(None, False, False, context._gateway.new_array(self.spark._jvm.double, 0), None)
        stages = [listed.apply(i) for i in range(listed.size())]
        rows = []
        for name, seconds in self.passed.items():
            ids = {stage for job in jobs.getJobIdsForGroup(f"{self.run} {name}") for stage in jobs.getJobInfo(job).stageIds}
            own = [stage for stage in stages if stage.stageId() in ids]
            rows.append((
                name, seconds, sum(s.executorRunTime() for s in own) / 1000, sum(s.numCompleteTasks() for s in own),
                sum(s.inputRecords() for s in own), sum(s.inputBytes() for s in own), sum(s.shuffleWriteBytes() for s in own),
                sum(s.outputRecords() for s in own), sum(s.outputBytes() for s in own),
            ))
        return in_memory(self.spark, rows, TASK_SCHEMA)


def with_rates(metrics: DataFrame, seconds: str = "total_seconds") -> DataFrame:
    """Throughput and latency beside (total_records, seconds); 0.0 where undefined."""
    records, time = F.col("total_records"), F.col(seconds)
    return metrics.withColumn(
        "records_per_second", F.when(time > 0, records / time).otherwise(F.lit(0.0))
    ).withColumn("ms_per_record", F.when(records > 0, time / records * 1000).otherwise(F.lit(0.0)))


def run_log(metrics: DataFrame, run_id: str, mode: str) -> DataFrame:
    """A run's times as rows (run_id, mode, task, seconds), the shape that runs are compared in."""
    tasks = [name for name in metrics.columns if name.endswith("_seconds")]
    pairs = F.array(
        *[
            F.struct(F.lit(name.removesuffix("_seconds")).alias("task"), F.col(name).alias("seconds"))
            for name in tasks
        ]
    )
    return metrics.select(F.lit(run_id).alias("run_id"), F.lit(mode).alias("mode"), F.inline(pairs))


def run_comparison(
    log: DataFrame, task: str, mode: str, seconds: str, base: str, other: str
) -> DataFrame:
    """Seconds per task in two modes, with labels and the speed-up of ``other`` over ``base``.

    The speed-up is 1 where the other mode took no time.
    """
    sides = (
        log.filter(F.col(mode).isin(base, other))
        .groupBy(task)
        .pivot(mode, [base, other])
        .agg(F.max(seconds))
        .withColumnsRenamed({base: "base_seconds", other: "other_seconds"})
    )
    base_s, other_s = F.col("base_seconds"), F.col("other_seconds")
    return sides.select(
        task,
        "base_seconds",
        "other_seconds",
        seconds_label(base_s).alias("base_label"),
        seconds_label(other_s).alias("other_label"),
        F.when(other_s > 0, base_s / other_s).when(other_s <= 0, F.lit(1.0)).alias("speedup"),
    )


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition: how even the work is."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def partition_count(df: DataFrame) -> DataFrame:
    """One row: how many partitions hold rows."""
    return partition_report(df).agg(F.count(F.lit(1)).alias("partition_count"))
