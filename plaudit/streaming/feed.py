"""The review feed: envelope, publishing, replay, decoding and quarantine.

A record is a ``key`` and a JSON ``value``, the shape of a message-log source or sink,
so files here and a message log in production take the same code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.functions import presets
from plaudit.functions.text import epoch_seconds, event_time
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.session import scoped_conf
from plaudit.sizing import parts_of
from plaudit.sources.readers import CORRUPT

ENVELOPE = f"review_id string, {CLEAN_TEXT} string, send_time double"


def envelope(
    df: DataFrame,
    key: str,
    text: str = CLEAN_TEXT,
    send_time: Column | None = None,
    keep: Iterable[Column] = (),
) -> DataFrame:
    """Rows as (key, value) records; ``send_time`` is in epoch seconds, by default now.

    The partition key comes from the review's id: a record that is sent again after a
    failure gets the same key, lands in the same partition and can be recognised. A review
    without an id cannot, so it is an error.
    """
    review_id = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit(f"a review without {key} cannot be sent")))
    stamped = F.unix_micros(F.current_timestamp()) / F.lit(1e6) if send_time is None else send_time
    value = F.to_json(
        F.struct(
            review_id.alias("review_id"),
            F.col(text).alias(CLEAN_TEXT),
            stamped.cast("double").alias("send_time"),
        )
    )
    spread_key = F.pmod(F.xxhash64(key), F.lit(presets.PARTITION_KEYS)).cast("string")
    return df.select(spread_key.alias("key"), value.alias("value"), *keep)


def publish(records: DataFrame, format: str = "json", mode: str = "append", **options: str) -> None:
    """Send records once, as a batch: to files, or to a message log with its connector."""
    records.write.format(format).mode(mode).options(**options).save()


def publish_new_files(
    spark: SparkSession,
    source: str,
    key: str,
    checkpoint: str,
    schema: str = ENVELOPE,
    files_per_batch: int | None = None,
    pause: str | None = None,
    format: str = "json",
    **options: str,
) -> None:
    """Send JSON files as they appear, a bounded number per micro-batch; each file is sent once.

    ``pause`` is the time between micro-batches; without it the run ends when
    nothing is new.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch or files_per_trigger(spark)).json(source)
    writer = (
        envelope(rows, key)
        .writeStream.format(format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    query = (writer.trigger(processingTime=pause) if pause else writer.trigger(availableNow=True)).start()
    query.awaitTermination()


def files_per_trigger(spark: SparkSession) -> int:
    """Files per micro-batch that give every core several."""
    return 4 * spark.sparkContext.defaultParallelism


def replay(
    reviews: DataFrame, key: str, text: str, time: str, folder: str, steps: int, after_step: Callable[[], None], copies: int = 1,
    **options: str,
) -> None:
    """Publish reviews to ``folder`` in the order of ``time``, step by step.

    ``after_step`` runs once a step lies there: a stream that stops when nothing is new and goes on
    from its checkpoint takes whole steps, so no record is late. The reviews are sorted into steps and
    parts once, by all cores; publishing moves nothing. Each is sent ``copies`` times; the copies are made as they are sent.
    ``options`` go to the files of the feed.
    """
    spark = reviews.sparkSession
    cores = spark.sparkContext.defaultParallelism
    parts = min(max(cores, -(-parts_of(reviews) // steps)), files_per_trigger(spark))  # of a step, which one micro-batch takes
    micros = F.unix_micros(F.col(time).cast("timestamp")).alias("_us")
    records = envelope(reviews, key, text, epoch_seconds(F.col(time)), keep=[micros, F.col(key).alias("_id")])
    with scoped_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):  # a part is of one step: nothing is sorted
        (
            records.repartitionByRange(steps * parts, "_us", "_id")
            .select("key", "value", F.floor(F.spark_partition_id() / parts).cast("int").alias("step"))
            .write.mode("overwrite")
            .partitionBy("step")
            .parquet(f"{folder}-staged")
        )
    staged = spark.read.schema("key string, value string, step int").parquet(f"{folder}-staged")
    if copies > 1:
        staged = staged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    for step in range(steps):
        publish(staged.filter(F.col("step") == step).select("key", "value"), path=folder, **options)
        after_step()


#: Formats of files, whose streams need a schema (fixed values).
FILE_FORMATS = ("json", "parquet", "orc", "csv", "avro")


def read_feed(
    spark: SparkSession, path: str | None = None, max_files: int | None = None, format: str = "json", **options: str
) -> DataFrame:
    """The feed as a stream of (key, value) records, a bounded amount per micro-batch.

    With files, ``max_files`` is the bound, by default as many as the cluster takes; ``options`` win over
    it. With a message log or another source, give its format and options (topic, starting point,
    records per batch); all of its partitions are read. A source without keys gives null keys.
    """
    reader = spark.readStream.format(format)
    if format in FILE_FORMATS:
        bound = {"maxFilesPerTrigger": str(max_files or files_per_trigger(spark))}
        reader = reader.schema("key string, value string").options(**bound)
    records = reader.options(**options).load(path)
    key = F.col("key") if "key" in records.columns else F.lit(None)
    return records.select(key.cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def decode(records: DataFrame) -> DataFrame:
    """Parse values; ``problem`` says why a record cannot be used and is null for good ones.

    The parsed record is exploded from an array of one: a filter on its fields stays above that, while below a plain
    column it would parse the value anew for each field that it names.
    """
    record = F.from_json(
        "value",
        f"{ENVELOPE}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    parsed = records.select("value", F.explode(F.array(record)).alias("_r"))
    problem = (
        F.when(F.col("value").isNull(), "no value")
        .when(F.col(f"_r.{CORRUPT}").isNotNull() | F.col("_r").isNull(), "not valid JSON")
        .when(F.col(f"_r.{CLEAN_TEXT}").isNull(), "no text")
        .when(F.col("_r.review_id").isNull(), "no id")
        .when(F.col("_r.send_time").isNull(), "no send time")
    )
    return parsed.select(
        "value",
        F.col("_r.review_id").alias("review_id"),
        F.col(f"_r.{CLEAN_TEXT}").alias(CLEAN_TEXT),
        F.col("_r.send_time").alias("send_time"),
        problem.alias("problem"),
    )


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("problem").isNull()).select(
        "review_id", CLEAN_TEXT, "send_time", event_time(F.col("send_time")).alias("send_ts")
    )


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("problem").isNotNull()).select("value", "problem")


def start_stream(
    df: DataFrame,
    checkpoint: str,
    sink,
    every: str | None = None,
    state_partitions: int | None = None,
    conf: dict[str, str] | None = None,
):
    """Start a query in append mode; ``every`` is the trigger interval, none means "until done".

    ``sink`` is a function from the stream writer to a configured one. The number of
    state partitions is fixed for the life of a checkpoint, so it is set here.
    """
    spark = df.sparkSession
    settings = dict(conf or {})
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    writer = sink(df.writeStream.outputMode("append").option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with scoped_conf(spark, settings):
        return writer.start()
