"""What a stream did, batch by batch, as a table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from plaudit.sources.readers import in_memory, read_if_there

PROGRESS_SCHEMA = (
    "query_id string, run_id string, name string, batch bigint, started string, input_rows bigint, output_rows bigint, "
    "late_rows bigint, state_rows bigint, state_bytes bigint, watermark string, batch_ms bigint, commit_ms bigint"
)


def progress_row(progress: dict) -> tuple:
    """A row of ``PROGRESS_SCHEMA`` from the JSON of a batch's progress. Late rows are those that operators with state dropped."""
    state, took = progress.get("stateOperators", []), progress.get("durationMs", {})
    return (
        progress["id"], progress["runId"], progress.get("name"), progress["batchId"], progress["timestamp"], progress["numInputRows"],
        progress.get("sink", {}).get("numOutputRows", -1),
        sum(op.get("numRowsDroppedByWatermark", 0) for op in state), sum(op.get("numRowsTotal", 0) for op in state),
        sum(op.get("memoryUsedBytes", 0) for op in state), progress.get("eventTime", {}).get("watermark"),
        took.get("triggerExecution", 0), took.get("commitOffsets", 0) + took.get("walCommit", 0),
    )


class ProgressLog(StreamingQueryListener):
    """Appends a row for each batch of all queries of a session to a folder, and the error of a query that ends with one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Events come by a queue of their own: what the queries have sent is taken first.
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._append([progress_row(json.loads(event.progress.json))], PROGRESS_SCHEMA, "batches")

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._append([(str(event.id), str(event.runId), event.exception)], "query_id string, run_id string, error string", "errors")

    def _append(self, rows: list[tuple], schema: str, name: str) -> None:
        in_memory(self.spark, rows, schema).coalesce(1).write.mode("append").json(f"{self.folder}/{name}")


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    return read_if_there(spark, f"{folder}/batches", PROGRESS_SCHEMA, "json")


def read_errors(spark: SparkSession, folder: str) -> DataFrame:
    return read_if_there(spark, f"{folder}/errors", "query_id string, run_id string, error string", "json")
