"""Sinks for batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plaudit.session import scoped_conf


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, *columns: str, format: str = "parquet", few: int = 0) -> None:
    """Replace only the partitions that ``df`` has rows for; other runs' partitions stay.

    A task sorts its rows by partition. If there are but a ``few``, it keeps a file open for each and nothing is sorted.
    """
    with scoped_conf(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(few)} if few else {}):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .format(format)
            .save(path)
        )


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line; null fields are written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of a few rows as a single JSON-lines file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file over another."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in (source, target)]
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    systems = [path.getFileSystem(conf) for path in paths]
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(systems[0], paths[0], systems[1], paths[1], False, True, conf)
