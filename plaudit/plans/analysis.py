"""Runs that write their results: ingestion, analysis of a sample, sweep over sample sizes."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.functions import presets
from plaudit.functions.sentiment import Lexicon, with_sentiment
from plaudit.functions.text import cleaned, has_content
from plaudit.operators.ingest import CLEAN_TEXT, exclude_texts, non_blank
from plaudit.operators.metrics import TaskTimes, observed, partition_count, sentiment_measures, with_rates
from plaudit.operators.sampling import (
    bernoulli_sample, checked_percents, first_rows, hash_sample, smallest_level, smallest_limit, sweep_word_frequency,
)
from plaudit.operators.words import ranked, top_words, word_frequency, word_rows
from plaudit.sizing import leaves_cores_idle, spread
from plaudit.operators.scoring import with_table_sentiment
from plaudit.sources.readers import CORRUPT, REVIEW_ID, in_memory, read_json_lines, read_reviews, size_report
from plaudit.sources.writers import write_parquet, write_partitions, write_report


def ingest(
    spark: SparkSession, source: str, target: str, text: str = "reviewText", id_column: str | None = None,
    set_aside: bool = False,
) -> dict:
    """Raw JSON lines to clean Parquet; returns the counts, taken while writing.

    A unique id in the raw lines is kept as ``review_id``. Without one, a review's id is its
    place in the clean files, which every reader derives alike (``readers.read_reviews``).

    With ``set_aside`` lines that cannot be used are kept as well: one scan is dealt by what becomes of a line into
    ``target/status=clean``, ``status=malformed`` and ``status=without_text``. ``clean`` in the result is the folder of the clean reviews.
    """
    keep = [REVIEW_ID] if id_column else []
    lines = routed_lines(spark, source, text, id_column) if set_aside else _parsed_lines(spark, source, text, id_column)
    lines, seen = observed(
        lines,
        "ingest-raw",
        [
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("status") == "malformed").alias("malformed"),
            F.count_if(F.col("status") == "without_text").alias("without_text"),
        ],
    )
    if set_aside:
        write_partitions(lines, target, "status", few=3)
        clean = f"{target}/status=clean"
    else:
        write_parquet(lines.filter(F.col("status") == "clean").select(*keep, CLEAN_TEXT), target)
        clean = target
    size = size_report(spark, clean, ".parquet").first()
    counts = dict(seen.get)
    return {
        **counts,
        "ingested": counts["lines"] - counts["malformed"] - counts["without_text"],
        "files": size["files"],
        "gib": size["gib"],
        "clean": clean,
    }


def _raw_schema(text: str, id_column: str | None) -> str:
    return f"`{text}` string" + (f", `{id_column}` string" if id_column else "")


def _parsed_lines(spark: SparkSession, source: str, text: str, id_column: str | None) -> DataFrame:
    """Lines with their status, without their raw text."""
    raw = read_json_lines(spark, source, _raw_schema(text, id_column), with_corrupt=True)
    kept = [F.col(id_column).alias(REVIEW_ID)] if id_column else []
    return raw.select(*kept, cleaned(F.col(text)).alias(CLEAN_TEXT), line_status(F.col(CORRUPT), F.col(text)).alias("status"))


def routed_lines(spark: SparkSession, source: str, text: str = "reviewText", id_column: str | None = None) -> DataFrame:
    """([review_id], text, line, source_file, status): clean reviews, and the others as the lines that they were, with their file."""
    schema = f"{_raw_schema(text, id_column)}, {CORRUPT} string"
    parsed = spark.read.text(source).filter(has_content(F.col("value"))).select(
        "value", F.col("_metadata.file_path").alias("source_file"),
        F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_r"),
    )
    status = line_status(F.col(f"_r.{CORRUPT}"), F.col(f"_r.{text}"))
    kept = [F.col(f"_r.{id_column}").alias(REVIEW_ID)] if id_column else []
    aside = status != "clean"
    return parsed.select(
        *kept, cleaned(F.col(f"_r.{text}")).alias(CLEAN_TEXT), F.when(aside, F.col("value")).alias("line"),
        F.when(aside, F.col("source_file")).alias("source_file"), status.alias("status"),
    )


def line_status(corrupt: Column, text: Column) -> Column:
    return F.when(corrupt.isNotNull(), "malformed").when(text.isNull(), "without_text").otherwise("clean")


def scored_by(rows: DataFrame, text: str, lexicon: Lexicon | DataFrame | None, scorer=None) -> DataFrame:
    """Rows scored by word lists, by a table of words of any size, or by a plug-in."""
    if isinstance(lexicon, DataFrame):
        return with_table_sentiment(rows, text, lexicon)
    return with_sentiment(rows, text, lexicon, scorer)


def run_analysis(
    spark: SparkSession,
    source: str,
    target: str,
    percent: int = 100,
    key: str | None = None,
    seed: int = 0,
    limit: int | None = None,
    lexicon: Lexicon | DataFrame | None = None,
    scorer: Callable[[str], float] | None = None,
    stop_words: Iterable[str] = presets.ENGLISH_STOP_WORDS,
    placeholders: Iterable[str] = (),
    partitions: int | None = None,
    keep_in_memory: bool | None = None,
    sort_words: bool = False,
    text: str = CLEAN_TEXT,
) -> DataFrame:
    """Word counts and sentiment of a sample; everything lands in ``target``, by ``pct``.

    Each of the two results is computed once, while it is written; reports and
    measures come from what was written or observed. With a ``key`` the sample is
    drawn by its hash, else by chance with a fixed seed, so both passes see
    the same rows; ``limit`` keeps the rows with the smallest keys. ``keep_in_memory`` caches the rows between the passes; by default
    only an input too small to busy all cores is cached, a large one is read twice.
    Returns the metrics as one row: ``read_seconds`` is the time to plan the sample and, if it is kept in
    memory, to fetch it; ``save_seconds`` that of the reports. What the executors took, read and wrote for each
    task lies in ``tasks``, by ``pct``: a lazy input is charged to the tasks that read it.
    """
    times = TaskTimes(spark)
    with times.task("read"):
        rows = exclude_texts(non_blank(read_reviews(spark, source), text), text, placeholders)
        if percent < 100:
            rows = hash_sample(rows, key, percent) if key else bernoulli_sample(rows, percent / 100, seed)
        if limit is not None:
            if not key:
                raise ValueError("a row limit needs a key: without one the two passes could read different rows")
            rows = first_rows(rows, key, limit)
        rows = rows.select(*([REVIEW_ID] if isinstance(lexicon, DataFrame) else []), text)
        if keep_in_memory is None:
            keep_in_memory = leaves_cores_idle(rows)
        rows = rows.repartition(partitions) if partitions else spread(rows)
        if keep_in_memory:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            rows.write.format("noop").mode("overwrite").save()
    try:
        with times.task("words"):
            frequency = word_frequency(word_rows(rows, text, stop_words=stop_words))
            frequency = ranked(frequency) if sort_words else frequency
            write_partitions(frequency.withColumn("pct", F.lit(percent)), f"{target}/word_frequency", "pct")
        with times.task("save"):
            written = spark.read.schema("word string, frequency bigint, pct int").parquet(f"{target}/word_frequency")
            written = written.filter(F.col("pct") == percent)
            write_report(top_words(written.select("word", "frequency")), f"{target}/top_words/pct={percent}")
        with times.task("sentiment"):
            scored = scored_by(rows, text, lexicon, scorer)
            scored, seen = observed(scored, f"analysis-{percent}", sentiment_measures())
            scored = scored.withColumnRenamed("polarity", "compound").withColumn("pct", F.lit(percent))
            write_partitions(scored, f"{target}/sentiment", "pct")
    finally:
        if keep_in_memory:
            rows.unpersist()
    with times.task("save"):
        measures = dict(seen.get)
        counts = in_memory(
            spark,
            [(name, measures[f"{name}_count"]) for name in presets.CATEGORIES],
            "category string, count bigint",
        )
        write_report(counts, f"{target}/categories/pct={percent}")
    written = spark.read.schema("category string, pct int").parquet(f"{target}/sentiment")
    parts = partition_count(written.filter(F.col("pct") == percent))
    passed = times.passed
    metrics = in_memory(
        spark,
        [
            (
                percent,
                measures["total_records"],
                float(measures["avg_sentiment"]),
                *[measures[f"{name}_count"] for name in presets.CATEGORIES],
                *[passed[name] for name in ("read", "words", "sentiment", "save")],
                sum(passed.values()),
                parts.first()["partition_count"],
            )
        ],
        "pct int, total_records bigint, avg_sentiment double, positive_count bigint, negative_count bigint, "
        "neutral_count bigint, read_seconds double, words_seconds double, sentiment_seconds double, "
        "save_seconds double, total_seconds double, "
        "partition_count bigint",
    )
    metrics = with_rates(metrics)
    write_report(metrics, f"{target}/metrics/pct={percent}")
    write_report(times.table(), f"{target}/tasks/pct={percent}")
    return metrics


def sweep_metrics(
    scored: DataFrame, key: str, percents: Iterable[int] = presets.FRACTIONS
) -> DataFrame:
    """Rows, mean polarity and category counts for every sample size, from one pass."""
    percents = checked_percents(percents)
    return metrics_by_level(scored.withColumn("_level", smallest_level(key, percents)), percents)


def limit_metrics(scored: DataFrame, key: str, limits: dict[int, int] = presets.ROW_LIMITS) -> DataFrame:
    """The same for every row limit, given as label: first rows by key."""
    return metrics_by_level(scored.withColumn("_level", smallest_limit(scored, key, limits)), sorted(limits))


def metrics_by_level(leveled: DataFrame, percents: Iterable[int]) -> DataFrame:
    """Measures of rows marked with ``_level``, the smallest sample that holds them."""

    def within(percent: int, name: str | None = None):
        inside = F.col("_level") <= percent
        return inside & (F.col("category") == name) if name else inside

    measures, structs = [], []
    for p in percents:
        measures += [
            F.count_if(within(p)).alias(f"n_{p}"),
            F.coalesce(F.avg(F.when(within(p), F.col("polarity"))), F.lit(0.0)).alias(f"avg_{p}"),
            *[F.count_if(within(p, name)).alias(f"{name}_{p}") for name in presets.CATEGORIES],
        ]
        structs.append(
            F.struct(
                F.lit(p).alias("pct"),
                F.col(f"n_{p}").alias("total_records"),
                F.col(f"avg_{p}").alias("avg_sentiment"),
                *[F.col(f"{name}_{p}").alias(f"{name}_count") for name in presets.CATEGORIES],
            )
        )
    return leveled.agg(*measures).select(F.inline(F.array(*structs)))


def run_sweep(
    spark: SparkSession,
    source: str,
    target: str,
    key: str,
    percents: Iterable[int] = presets.FRACTIONS,
    lexicon: Lexicon | DataFrame | None = None,
    text: str = CLEAN_TEXT,
    **word_options,
) -> None:
    """Word counts and measures of all sample sizes: two passes in place of one run per size."""
    rows = non_blank(read_reviews(spark, source), text)
    rows = spread(rows.select(*dict.fromkeys((key, *([REVIEW_ID] if isinstance(lexicon, DataFrame) else []), text))))
    words = sweep_word_frequency(rows, key, text, percents, **word_options)
    write_partitions(words, f"{target}/word_frequency", "pct")
    scored = scored_by(rows, text, lexicon)
    write_report(sweep_metrics(scored, key, percents), f"{target}/metrics")
