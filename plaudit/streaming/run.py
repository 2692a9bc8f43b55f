"""A feed's results from one reading of it: scored records, set-aside records and top words per window.

One query hands each micro-batch to a function that writes

- ``scored``: records that hold a keyword, with their sentiment;
- ``set_aside``: records that cannot be used, with the reason;
- ``top_words``: one document per window that has finished;
- ``_minutes``: word counts per slide, from which windows are added up once they finish;
- ``_ids``: the ids that were kept, if repeats are to be dropped;

each into ``run=<query id>/batch=<number>`` of its folder, and last of all a record of the batch to ``_batches``. The query id
belongs to the checkpoint, so two checkpoints may share a folder. A batch that runs again, after a crash at whatever point, writes its
own folders anew; a batch that has its record is done. Readers take batches with a record only, so nothing half-written is seen.

The record also carries what the next batch has to know: the watermark (the latest time of a kept record, less the delay) and the batches whose counts and
ids are still needed. That is all the state there is. A record is *late* if all its windows have
been written, or, where repeats are dropped, if it is older than the watermark: then it is dropped, as its twin may be forgotten.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from plaudit.functions import presets
from plaudit.functions.sentiment import Lexicon, with_sentiment
from plaudit.functions.text import event_time, matches_keyword
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.operators.scoring import with_table_sentiment
from plaudit.operators.windows import top_of_parts, top_per_window, window_documents
from plaudit.session import scoped_conf
from plaudit.sizing import PART_BYTES, dealt
from plaudit.sources.readers import in_memory, read_if_there
from plaudit.streaming.feed import decode, start_stream
from plaudit.streaming.top_words import DOCUMENT_SCHEMA, feed_words

BATCH_SCHEMA = (
    "records bigint, set_aside bigint, wanted bigint, repeats bigint, late bigint, kept bigint, windows bigint, "
    "watermark_us bigint, seconds double, open array<struct<batch: bigint, last_us: bigint>>"
)
PLACE_SCHEMA = "run string, batch bigint"
SCORED_SCHEMA = f"review_id string, {CLEAN_TEXT} string, send_us bigint, polarity double, category string"
SET_ASIDE_SCHEMA = "value string, problem string"
COUNTS = "word string, total bigint, positive bigint, negative bigint, neutral bigint"
MINUTE_SCHEMA = f"slide bigint, {COUNTS}"
WINDOW_SCHEMA = f"window_start timestamp, window_end timestamp, {COUNTS}"
ID_SCHEMA = "review_id string, send_us bigint"
MICROS = 1_000_000


#: What a task of a micro-batch reads at most, of files and of shuffles: its counts and sorted rows grow with that.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}


def _bounded_tasks(spark: SparkSession) -> dict[str, str]:
    """The bounds for a query's session, where the user has not set any."""
    return {key: f"{most}b" for key, most in TASK_BYTES.items() if key not in spark.conf.getAll}


@dataclass(frozen=True)
class FeedRun:
    """What is done with each micro-batch. ``after`` is called with a sink's name and the batch's number once the sink is written."""

    folder: str
    lexicon: Lexicon | DataFrame | None = None
    keywords: tuple[str, ...] = presets.STREAM_KEYWORDS
    delay_seconds: int = 120
    drop_repeats: bool = False
    k: int = presets.WINDOW_TOP_WORDS
    window_seconds: int = presets.WINDOW_SECONDS
    slide_seconds: int = presets.SLIDE_SECONDS
    stop_words: tuple[str, ...] = presets.STREAM_STOP_WORDS
    after: Callable[[str, int], None] | None = None

    def __post_init__(self) -> None:
        if self.window_seconds % self.slide_seconds:
            raise ValueError("a window is made of whole slides")

    def start(self, records: DataFrame, checkpoint: str, every: str | None = None):
        """Start the query over (key, value) records; without ``every`` it ends when nothing is new."""
        rows = decode(records)
        bad = F.col("problem").isNotNull()
        rows = rows.filter(bad | matches_keyword(F.col(CLEAN_TEXT), self.keywords)).select(
            F.when(bad, F.col("value")).alias("value"), "problem", "review_id", CLEAN_TEXT,
            F.unix_micros(event_time(F.col("send_time"))).alias("send_us"),
        )
        return start_stream(rows, checkpoint, lambda writer: writer.foreachBatch(self.write_batch), every=every, conf=_bounded_tasks(records.sparkSession))

    def write_batch(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        with scoped_conf(spark, {"spark.sql.adaptive.enabled": "true"}):
            if self._record(spark, run, number) is not None:
                return
            before = self._record(spark, run, number - 1) if number else None
            if number and before is None:
                raise ValueError(f"{self.folder} has no record of batch {number - 1} of {run}: it is not this checkpoint's folder")
            rows = batch.persist(StorageLevel.MEMORY_AND_DISK)  # the feed is read once for all sinks
            try:
                self._write(spark, rows, run, number, before)
            finally:
                rows.unpersist()

    def _write(self, spark: SparkSession, rows: DataFrame, run: str, number: int, before: Row | None) -> None:
        begun = time.time()
        old_mark = before.watermark_us if before else None
        open_batches = [entry.asDict() for entry in before.open] if before else []
        bad, us = F.col("problem").isNotNull(), F.col("send_us")
        seen = rows.agg(
            F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("set_aside"), F.max(F.when(~bad, us)).alias("last_us"),
            F.count_if(~bad & self._before(us, old_mark)).alias("old"),
        ).first()
        wanted = seen.records - seen.set_aside
        self._put(rows.filter(bad).select("value", "problem"), "set_aside", run, number)

        good = rows.filter(~bad).select("review_id", CLEAN_TEXT, "send_us")
        if self.drop_repeats:
            good = self._unique(spark, good.filter(~self._before(us, old_mark)), run, number, old_mark, open_batches)
        self._put(self._scored(good), "scored", run, number)
        scored = self._get(spark, "scored", SCORED_SCHEMA, run, [number])
        slide = F.floor(us / (self.slide_seconds * MICROS)) * self.slide_seconds
        finished = self._before((slide + self.window_seconds) * MICROS, old_mark, including=True)
        kept = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(finished).alias("late")).first()
        if self.drop_repeats:
            self._put(scored.select("review_id", "send_us"), "_ids", run, number)

        words = feed_words(
            scored.filter(~finished).withColumn("_slide", slide.cast("bigint")), time="_slide", stop_words=self.stop_words
        )
        counts = words.groupBy(F.col("_slide").alias("slide"), "word").agg(
            F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("category") == name).alias(name) for name in presets.CATEGORIES]
        )
        self._put(counts, "_minutes", run, number)

        marks = [mark for mark in (old_mark, None if seen.last_us is None else seen.last_us - self.delay_seconds * MICROS) if mark is not None]
        new_mark = max(marks, default=None)
        if seen.last_us is not None:
            open_batches.append({"batch": number, "last_us": seen.last_us})
        top = self._finished_windows(spark, run, [entry["batch"] for entry in open_batches], old_mark, new_mark)
        self._put(window_documents(top), "top_words", run, number, format="json")
        windows = self._get(spark, "top_words", DOCUMENT_SCHEMA, run, [number], format="json").count()

        # Counts are needed while a window may still hold them, ids while a repeat may still be dropped.
        reach = max(self.window_seconds, self.delay_seconds) * MICROS
        still_open = [(entry["batch"], entry["last_us"]) for entry in open_batches if entry["last_us"] + reach >= new_mark]
        late = seen.old if self.drop_repeats else kept.late
        repeats = wanted - seen.old - kept.n if self.drop_repeats else 0
        record = (
            seen.records, seen.set_aside, wanted, repeats, late, kept.n, windows, new_mark, time.time() - begun,
            [{"batch": batch, "last_us": last} for batch, last in still_open],
        )
        self._put(in_memory(spark, [record], BATCH_SCHEMA).coalesce(1), "_batches", run, number, format="json")

    def _before(self, us: Column, mark: int | None, including: bool = False) -> Column:
        if mark is None:
            return F.lit(False)
        return us <= F.lit(mark) if including else us < F.lit(mark)

    def _unique(
        self, spark: SparkSession, good: DataFrame, run: str, number: int, mark: int | None, open_batches: list[dict]
    ) -> DataFrame:
        """One record per id, the earliest, of ids that were not kept within the delay. Copies meet reduced to one per task."""
        first = good.groupBy("review_id").agg(F.min(F.struct("send_us", CLEAN_TEXT)).alias("first"))
        unique = first.select("review_id", f"first.{CLEAN_TEXT}", "first.send_us")
        batches = [entry["batch"] for entry in open_batches]
        if not batches:
            return unique
        known = self._get(spark, "_ids", ID_SCHEMA, run, batches)
        if mark is not None:
            known = known.filter(F.col("send_us") + self.delay_seconds * MICROS >= mark)
        return unique.join(known.select("review_id"), "review_id", "left_anti")

    def _scored(self, good: DataFrame) -> DataFrame:
        if isinstance(self.lexicon, DataFrame):
            return with_table_sentiment(good, CLEAN_TEXT, self.lexicon)
        return with_sentiment(good, CLEAN_TEXT, self.lexicon)

    def _finished_windows(self, spark: SparkSession, run: str, batches: list[int], old_mark: int | None, new_mark: int | None) -> DataFrame:
        """The best words of the windows that end after the old watermark and not after the new one."""
        if not batches or new_mark is None:
            return top_per_window(in_memory(spark, [], WINDOW_SCHEMA), self.k)
        counts = self._get(spark, "_minutes", MINUTE_SCHEMA, run, batches)
        # All counts of a word meet in one task, which adds them up per window and sends on its best words only.
        counts = dealt(counts, "word", part_bytes=PART_BYTES * self.slide_seconds // self.window_seconds)
        return top_per_window(top_of_parts(counts, self.k, self.window_seconds, self.slide_seconds, old_mark, new_mark), self.k)

    def _put(self, df: DataFrame, sink: str, run: str, number: int, format: str = "parquet") -> None:
        df.write.mode("overwrite").format(format).option("ignoreNullFields", False).save(f"{self.folder}/{sink}/run={run}/batch={number}")
        if self.after:
            self.after(sink, number)

    def _get(self, spark: SparkSession, sink: str, schema: str, run: str, numbers: list[int], format: str = "parquet") -> DataFrame:
        paths = [f"{self.folder}/{sink}/run={run}/batch={number}" for number in numbers]
        return spark.read.format(format).schema(schema).load(paths)

    def _record(self, spark: SparkSession, run: str, number: int) -> Row | None:
        return read_if_there(spark, f"{self.folder}/_batches/run={run}/batch={number}", BATCH_SCHEMA, "json").first()


def batches(spark: SparkSession, folder: str) -> DataFrame:
    """One row per finished batch of every run: what it read, kept and dropped, its watermark and its time."""
    return read_if_there(spark, f"{folder}/_batches", f"{BATCH_SCHEMA}, {PLACE_SCHEMA}", "json")


def _finished(spark: SparkSession, folder: str, sink: str, schema: str, format: str = "parquet") -> DataFrame:
    rows = read_if_there(spark, f"{folder}/{sink}", f"{schema}, {PLACE_SCHEMA}", format)
    return rows.join(batches(spark, folder).select("run", "batch"), ["run", "batch"], "left_semi")


def read_scored(spark: SparkSession, folder: str) -> DataFrame:
    return _finished(spark, folder, "scored", SCORED_SCHEMA)


def read_set_aside(spark: SparkSession, folder: str) -> DataFrame:
    return _finished(spark, folder, "set_aside", SET_ASIDE_SCHEMA)


def read_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _finished(spark, folder, "top_words", DOCUMENT_SCHEMA, "json")
