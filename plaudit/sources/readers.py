"""Sources: JSON lines, Parquet, file listings and small in-memory tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"
REVIEW_ID = "review_id"


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: str = "reviewText string",
    glob: str | None = None,
    with_corrupt: bool = False,
) -> DataFrame:
    """JSON lines with a fixed schema: no inference pass, other fields ignored.

    A malformed line becomes a row of nulls; ``with_corrupt`` keeps its raw text in
    ``_corrupt_record``.
    """
    wanted = T.StructType.fromDDL(schema)
    reader = spark.read.option("multiLine", False)
    if with_corrupt:
        wanted = wanted.add(CORRUPT, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.schema(wanted).json(path)


def read_parquet(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: str, format: str = "parquet") -> DataFrame:
    """A table, without rows if there is no such path yet."""
    try:
        return spark.read.format(format).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return in_memory(spark, [], schema)


def row_place(root: str) -> Column:
    """A row's file below ``root`` and its number in it: an exact id that every later read gives again.

    For Parquet files, which are not changed once written.
    """
    return F.concat(relative_path("_metadata.file_path", root), F.lit(":"), F.col("_metadata.row_index").cast("string"))


def relative_path(path: str, root: str) -> Column:
    """The part of a file's path below the root folder: equal names in sub-folders stay apart.

    A root that is spelled differently in the paths leaves them whole, which names the
    files just as well.
    """
    folder = "/" + root.rstrip("/").split("://")[-1].removeprefix("file:").lstrip("/") + "/"
    start = F.locate(folder, F.col(path))
    below = F.substring(F.col(path), start + len(folder), F.length(path))
    return F.when(start > 0, below).otherwise(F.col(path))


def with_review_id(rows: DataFrame, root: str) -> DataFrame:
    """Rows of a Parquet scan with a ``review_id`` as text: their own, or their place in the source."""
    place = row_place(root)
    own = F.coalesce(F.col(REVIEW_ID).cast("string"), place) if REVIEW_ID in rows.columns else place
    return rows.select(own.alias(REVIEW_ID), *[name for name in rows.columns if name != REVIEW_ID])


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Clean reviews, every one with a ``review_id``."""
    return with_review_id(spark.read.parquet(path), path)


def list_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, length, modified, file_path) of all files below a folder with the suffix.

    Contents are not read: only listing columns reach the scan. ``file_path`` is
    spelled as in the ``_metadata`` of any other scan of the same file.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("file_path"))
    )


def size_report(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """One row: files, bytes and GiB below a folder."""
    return (
        list_files(spark, path, suffix)
        .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .withColumn("gib", F.col("bytes") / F.lit(1024.0**3))
    )


def in_memory(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small constant table, such as word lists or sample sizes.

    Handed over as Arrow it becomes a local relation: Catalyst knows its size and no
    Python worker is started for it.
    """
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    data = pa.table({name: list(values) for name, values in zip(fields.names, columns)})
    return spark.createDataFrame(data, fields)
