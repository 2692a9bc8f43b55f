"""Incremental Parquet to JSON-lines conversion."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.sources.readers import REVIEW_ID, list_files, read_if_there, relative_path, with_review_id
from plaudit.sources.writers import remove, write_partitions

#: A file as it was converted: rewritten in place it has another length or time.
DONE_SCHEMA = "source_file string, length bigint, modified timestamp, converted timestamp"
#: A manifest of more files is rewritten as one.
MANIFEST_FILES = 64


def done_files(spark: SparkSession, target: str) -> DataFrame:
    """(source_file, length, modified) of each file as it was last converted."""
    manifest = read_if_there(spark, f"{target}/_manifest", f"{DONE_SCHEMA}, run string")
    last = F.max_by(F.struct("length", "modified"), "converted").alias("last")
    return manifest.groupBy("source_file").agg(last).select("source_file", "last.length", "last.modified")


def files_per_round(spark: SparkSession) -> int:
    """Files that keep every core busy for a while."""
    return max(10_000, 64 * spark.sparkContext.defaultParallelism)


def pending_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(path, source_file, length, modified) of Parquet files that have not been converted as they are now: an anti join."""
    files = list_files(spark, source, ".parquet").select(
        "path", relative_path("file_path", source).alias("source_file"), "length", "modified"
    )
    return files.join(done_files(spark, target), ["source_file", "length", "modified"], "left_anti")


def scan_files(spark: SparkSession, paths: list[str], columns: Iterable[str], source: str) -> DataFrame:
    """The wanted columns (as text) and ``source_file`` of Parquet files whose schemas may differ.

    Footers are merged by Spark; a file without a column has nulls there. Files that give a column different types
    can't be scanned together and are read by groups of equal schema.
    """

    def wanted(scan: DataFrame) -> DataFrame:
        rows = with_review_id(scan.withColumn("source_file", relative_path("_metadata.file_path", source)), source)
        return rows.select(
            *[(F.col(name) if name in rows.columns else F.lit(None)).cast("string").alias(name) for name in columns], "source_file"
        )

    try:
        return wanted(spark.read.option("mergeSchema", True).parquet(*paths))
    except Py4JJavaError as error:  # Spark's own exception has no class in Python
        if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
            raise
    by_schema = defaultdict(list)
    for path in paths:
        by_schema[spark.read.parquet(path).schema.json()].append(path)
    return reduce(DataFrame.unionByName, [wanted(spark.read.parquet(*same)) for same in by_schema.values()])


def convert_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    columns: tuple[str, ...] = (REVIEW_ID, CLEAN_TEXT),
    files_per_batch: int | None = None,
) -> int:
    """Convert what is pending, a bounded number of files at a time; returns the number converted.

    Each source file has its own partition below ``target/data``. A file is noted as
    done, as it was listed, only after its rows are committed, and a file converted again, also one that was rewritten in place, replaces its
    own partition, so a run that dies half-way is simply repeated. Rows without a
    ``review_id`` get their place in the source, file by file. A file that is rewritten without rows keeps its old partition.
    """
    files_per_batch = files_per_batch or files_per_round(spark)
    pending = pending_files(spark, source, target)
    count = pending.count()
    if not count:
        return 0
    # The list is made once and cut into batches by path, so no run lists the source twice.
    batches = -(-count // files_per_batch)
    run = uuid.uuid4().hex[:12]
    plan = f"{target}/_pending/{run}"
    (
        pending.repartitionByRange(batches, "path")
        .withColumn("batch", F.spark_partition_id())
        .write.partitionBy("batch")
        .parquet(plan)
    )
    planned = spark.read.schema("source_file string, path string, length bigint, modified timestamp, batch int").parquet(plan)
    for number in range(batches):
        files = planned.filter(F.col("batch") == number)
        paths = [row.path for row in files.select("path").collect()]
        if not paths:
            continue
        write_partitions(scan_files(spark, paths, columns, source), f"{target}/data", "source_file", format="json")
        done = files.select("source_file", "length", "modified", F.current_timestamp().alias("converted"))
        done.coalesce(1).write.mode("append").parquet(f"{target}/_manifest/run={run}")
    compact_manifest(spark, target)
    return count


def compact_manifest(spark: SparkSession, target: str, most_files: int = MANIFEST_FILES) -> None:
    """Rewrite a manifest of many files; the old ones go once the new one is there, and until then both say the same."""
    manifest = read_if_there(spark, f"{target}/_manifest", f"{DONE_SCHEMA}, run string")
    if len(manifest.inputFiles()) <= most_files:
        return
    old = [row.run for row in manifest.select("run").distinct().collect()]
    run = uuid.uuid4().hex[:12]
    done_files(spark, target).withColumn("converted", F.current_timestamp()).write.parquet(f"{target}/_manifest/run={run}")
    for name in old:
        remove(spark, f"{target}/_manifest/run={name}")


def convert_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str = f"{CLEAN_TEXT} string",
    files_per_batch: int | None = None,
) -> None:
    """The same as a stream that stops when nothing is new: the checkpoint remembers the files."""
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch or files_per_round(spark))
        .option("pathGlobFilter", "*.parquet")
        .parquet(source)
    )
    query = (
        with_review_id(rows, source)
        .writeStream.format("json")
        .option("path", target)
        .option("ignoreNullFields", False)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
