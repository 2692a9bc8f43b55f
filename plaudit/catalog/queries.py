"""Registered queries over the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plaudit.catalog import corpus
from plaudit.functions import presets
from plaudit.functions.sentiment import with_sentiment
from plaudit.functions.text import (
    batch_tokens_with_empty,
    epoch_seconds,
    event_time,
    letter_words,
    stream_tokens,
)
from plaudit.operators import ingest, keywords, metrics, sampling, scoring, windows, words
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.plans.analysis import ingest as ingest_raw, limit_metrics, run_analysis, sweep_metrics
from plaudit.plans.profile import text_profile
from plaudit.session import work_dir
from plaudit.sizing import dealt, parts_of, rounds, spread
from plaudit.sources import convert, readers, writers
from plaudit.streaming import feed, run, top_words as stream
from plaudit.streaming.progress import ProgressLog, read_progress
from plaudit.streaming.run import FeedRun

Query = Callable[[SparkSession, str], DataFrame]

#: What one task writes into a file of the mixed folder.
FILE_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def utc(column: str) -> Column:
    """A time without a zone as a time in UTC, whatever the session's zone."""
    return F.concat(F.col(column).cast("string"), F.lit("Z")).cast("timestamp")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean texts with the time at which they are sent."""
    times = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), utc("ts").alias("send_ts"))
    texts = ingest.clean_reviews(documents(spark, sf_dir), "text", keep=["doc_id"])
    return texts.join(times, "doc_id").withColumnRenamed("doc_id", "review_id")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sentiment(documents(spark, sf_dir), "text", corpus.LEXICON)


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_rows(documents(spark, sf_dir), "text")


# Ingestion, sources and sinks


def ingest_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.clean_reviews(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    return ingest.non_blank(rows)


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines of three kinds: reviews with more fields, objects without a review, markup."""
    folder = work_dir(spark, "ingest")
    raw = table(spark, sf_dir, "documents").select(
        F.to_json(F.struct(F.col("text").alias("reviewText"), "doc_id", "lang", "n_chars")).alias("value")
    )
    other = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    markup = table(spark, sf_dir, "pages").select(F.regexp_replace("html", r"[\r\n]", " ").alias("value"))
    raw.unionByName(other).unionByName(markup).write.text(f"{folder}/raw")
    lines = readers.read_json_lines(spark, f"{folder}/raw")
    writers.write_parquet(ingest.clean_reviews(lines), f"{folder}/clean")
    return readers.read_parquet(spark, f"{folder}/clean", glob="part-*.parquet")


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON, kept with their raw text."""
    folder = work_dir(spark, "malformed")
    raw = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    markup = table(spark, sf_dir, "pages").select(F.regexp_replace("html", r"[\r\n]", " ").alias("value"))
    raw.unionByName(markup).write.text(folder)
    lines = readers.read_json_lines(spark, folder, "reviewText string, k bigint", with_corrupt=True)
    return lines.filter(F.col("k").isNull() & F.col(readers.CORRUPT).isNotNull()).select(
        F.col(readers.CORRUPT).alias("line")
    )


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of three kinds in one pass: clean reviews, and lines that are no JSON or hold no review as they were."""
    folder = work_dir(spark, "quarantine-batch")
    raw = table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.col("text").alias("reviewText"), "doc_id")).alias("value"))
    other = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    markup = table(spark, sf_dir, "pages").select(F.regexp_replace("html", r"[\r\n]", " ").alias("value"))
    raw.unionByName(other).unionByName(markup).write.text(f"{folder}/raw")
    ingest_raw(spark, f"{folder}/raw", f"{folder}/lines", id_column="doc_id", set_aside=True)
    lines = readers.read_parquet(spark, f"{folder}/lines")
    return _numbered(lines).select("status", "review_id", CLEAN_TEXT, "line", F.col("source_file").isNotNull().alias("has_file"))


def mixed_files_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with ids as numbers, ids as text and no ids, those of one kind rewritten in place: each converted by its own schema."""
    folder = work_dir(spark, "mixed")
    texts = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias(CLEAN_TEXT), "lang")
    files = parts_of(texts, FILE_BYTES)
    number, text = F.col("doc_id").alias("review_id"), F.concat(F.lit("doc "), "doc_id").alias("review_id")
    for name, rows in (
        ("a", texts.filter(_english(True)).select(CLEAN_TEXT)), ("b", texts.filter(_english(False)).select(text, CLEAN_TEXT)),
        ("c", texts.filter("doc_id % 3 = 0").select(number, CLEAN_TEXT)),
    ):
        writers.write_parquet(rows.coalesce(files), f"{folder}/source/{name}")
    convert.convert_new_files(spark, f"{folder}/source", f"{folder}/target")
    # The same file names with other rows: they are taken for new files, and their rows replace the old ones.
    changed = texts.filter("doc_id % 3 = 1").select(number, CLEAN_TEXT)
    old = _files(spark, f"{folder}/source/c")
    writers.write_parquet(changed.repartition(len(old)) if len(old) > 1 else changed.coalesce(1), f"{folder}/changed")
    for new_file, old_file in zip(_files(spark, f"{folder}/changed"), old, strict=True):
        writers.replace_file(spark, new_file, old_file)
    convert.convert_new_files(spark, f"{folder}/source", f"{folder}/target")
    rows = readers.read_json_lines(spark, f"{folder}/target/data", f"review_id string, {CLEAN_TEXT} string")
    own = F.when(F.col("review_id").rlike("^(doc )?[0-9]+$"), F.col("review_id"))
    return rows.select(own.alias("own_id"), CLEAN_TEXT)


def _files(spark: SparkSession, folder: str) -> list[str]:
    return sorted(row.path for row in readers.list_files(spark, folder, ".parquet").collect())


def json_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines written and read back by file pattern, nulls written as nulls."""
    folder = work_dir(spark, "json")
    writers.write_json_lines(ingest_clean(spark, sf_dir).select(CLEAN_TEXT), folder)
    return readers.read_json_lines(spark, folder, f"{CLEAN_TEXT} string", glob="part-*.json")


def _english(others: bool) -> Column:
    """Documents in English, or all others, those without a language among them."""
    english = F.col("lang").eqNullSafe("en")
    return ~english if others else english


def incremental_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Convert English texts, add the others, convert again: nothing twice, nothing left out."""
    folder = work_dir(spark, "convert")
    texts = table(spark, sf_dir, "documents").withColumn(CLEAN_TEXT, F.lower("text"))
    for others, subfolder in ((False, "first"), (True, "second")):
        writers.write_parquet(texts.filter(_english(others)).select(CLEAN_TEXT), f"{folder}/source/{subfolder}")
        convert.convert_new_files(spark, f"{folder}/source", f"{folder}/target")
    return readers.read_json_lines(spark, f"{folder}/target/data", f"{CLEAN_TEXT} string").select(CLEAN_TEXT)


def incremental_convert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "convert-stream")
    texts = table(spark, sf_dir, "documents").withColumn(CLEAN_TEXT, F.lower("text"))
    for others in (False, True):
        texts.filter(_english(others)).select(CLEAN_TEXT).write.mode("append").parquet(f"{folder}/source")
        convert.convert_stream(spark, f"{folder}/source", f"{folder}/target", f"{folder}/checkpoint")
    return readers.read_json_lines(spark, f"{folder}/target", f"{CLEAN_TEXT} string")


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "report")
    writers.write_report(top_words(spark, sf_dir), folder)
    return readers.read_json_lines(spark, folder, "word string, frequency bigint")


def output_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size report of a written folder against what a scan of its files says."""
    folder = work_dir(spark, "size")
    writers.write_parquet(ingest_clean(spark, sf_dir), folder)
    files = (
        readers.read_parquet(spark, folder)
        .groupBy(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("rows"), F.sum("size").alias("scanned"))
    )
    report = readers.size_report(spark, folder, ".parquet")
    return files.crossJoin(report).select(  # one row each
        "rows", (F.col("scanned") == F.col("bytes")).alias("bytes_match"),
        (F.col("gib") == F.col("bytes") / 1024**3).alias("gib_match"),
    )


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per language over the listed files, and whether the scan read just those files."""
    folder = work_dir(spark, "files")
    writers.write_parquet(table(spark, sf_dir, "documents").select("doc_id", "lang"), folder)
    rows = (
        readers.read_parquet(spark, folder)
        .groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"), "lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = readers.list_files(spark, folder, ".parquet").withColumnRenamed("file_path", "listed_path")
    return (
        rows.join(listed, F.col("file_path") == F.col("listed_path"), "left")
        .groupBy("lang")
        .agg(F.sum("n").alias("rows"), F.bool_and(F.coalesce(F.col("size") == F.col("length"), F.lit(False))).alias("listed"))
    )


def partition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows over all partitions and the number of partitions after a fixed repartition."""
    report = metrics.partition_report(table(spark, sf_dir, "documents").select("doc_id").repartition(16))
    return report.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("partitions"))


# Filters and samples


def exclude_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.exclude_texts(ingest_clean(spark, sf_dir), CLEAN_TEXT, corpus.PLACEHOLDERS)


def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.keyword_filter(ingest_clean(spark, sf_dir), CLEAN_TEXT, corpus.KEYWORDS)


def keyword_filter_whole_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.keyword_filter(ingest_clean(spark, sf_dir), CLEAN_TEXT, corpus.WHOLE_WORDS, whole_word=True)


def keyword_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords from a table: the longer words of the benchmark texts, and the first words of each as a phrase."""
    split = F.split("text", "[ \t\n\x0B\f\r]+")
    longer = table(spark, sf_dir, "benchmark").select(F.explode(split).alias("keyword")).filter(F.length("keyword") >= 12)
    phrases = table(spark, sf_dir, "benchmark").select(F.array_join(F.slice(split, 1, 4), " ").alias("keyword"))
    rows = ingest.non_blank(ingest.clean_reviews(documents(spark, sf_dir), "text", keep=["doc_id"]))
    return keywords.keyword_table_filter(rows, CLEAN_TEXT, longer.unionByName(phrases))


def default_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.keyword_filter(ingest_clean(spark, sf_dir), CLEAN_TEXT, presets.STREAM_KEYWORDS)


def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 40)


def bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a chance sample: a subset, no row twice, the same for the same seed, about the size asked for."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    one, again = (
        sampling.bernoulli_sample(docs, 0.2, seed=7).groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
        for name in ("taken", "again")
    )
    rows = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).join(one, "doc_id", "full").join(again, "doc_id", "full")
    n, taken, again = (F.coalesce(name, F.lit(0)) for name in ("n", "taken", "again"))
    return rows.agg(
        F.bool_and(taken <= n).alias("subset"),
        F.bool_and(taken == again).alias("same_again"),
        # Six standard deviations of the binomial.
        (F.abs(F.sum(taken) - 0.2 * F.sum(n)) <= 6 * F.sqrt(0.16 * F.sum(n))).alias("size_fits"),
    )


def bernoulli_sample_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bernoulli_sample(table(spark, sf_dir, "documents").select("doc_id"), 1.0, seed=7)


# Words


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_frequency(document_words(spark, sf_dir))


def word_frequency_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.ranked(word_frequency(spark, sf_dir))


def word_frequency_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = words.word_rows(
        documents(spark, sf_dir), "text", tokens=batch_tokens_with_empty, stop_words=(), keep_empty=True
    )
    return words.word_frequency(rows)


def word_frequency_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_frequency(words.word_rows(documents(spark, sf_dir), "text", strip_punct=True))


def word_frequency_stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop words from a table: all words of the provided benchmark texts."""
    stop = words.word_rows(table(spark, sf_dir, "benchmark"), "text", stop_words=())
    return words.drop_words(words.word_rows(documents(spark, sf_dir), "text", stop_words=()), stop)


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(word_frequency(spark, sf_dir))


def top_words_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampling.first_rows(
        table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", corpus.TOP_LIMITED_ROWS
    )
    return words.top_words(words.word_frequency(words.word_rows(rows, "text")))


def row_limit_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sweep_limits(documents(spark, sf_dir), "doc_id", "text", corpus.ROW_LIMITS)


def stream_word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = words.word_rows(
        documents(spark, sf_dir), "text", tokens=stream_tokens, stop_words=presets.STREAM_STOP_WORDS
    )
    return words.word_frequency(rows)


def fraction_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sweep_word_frequency(documents(spark, sf_dir), "doc_id", "text")


def fraction_sweep_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    fractions = readers.in_memory(spark, [(p,) for p in presets.FRACTIONS], "pct int")
    return sampling.sweep_by_range_join(documents(spark, sf_dir), "doc_id", "text", fractions)


def fraction_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one table by ``pct``: the second replaces only its own partitions."""
    folder = work_dir(spark, "fractions")
    rows = documents(spark, sf_dir)
    for percents in ((20, 40, 60), (60, 80, 100)):
        result = sampling.sweep_word_frequency(rows, "doc_id", "text", percents)
        writers.write_partitions(result, folder, "pct")
    return readers.read_parquet(spark, folder)


# Sentiment


def sentiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", "polarity", "category")


def sentiment_scores_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_sentiment(documents(spark, sf_dir), "text", corpus.LEXICON, form="arrow")
    return rows.select("doc_id", "polarity", "category")


def sentiment_scores_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scoring.lexicon_frame(spark, corpus.LEXICON)
    return scoring.score_by_join(documents(spark, sf_dir), "doc_id", "text", table)


def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.category_counts(scored(spark, sf_dir))


def sentiment_scores_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon as a table that is taken for too large to broadcast."""
    table = scoring.lexicon_frame(spark, corpus.LEXICON)
    return scoring.score_by_join(documents(spark, sf_dir), "doc_id", "text", table, max_broadcast_rows=0)


def sentiment_counts_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampling.first_rows(
        table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", corpus.TOP_LIMITED_ROWS
    )
    return scoring.category_counts(with_sentiment(rows, "text", corpus.LEXICON))


def row_limit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_metrics(scored(spark, sf_dir), "doc_id", corpus.ROW_LIMITS).withColumn(
        "avg_sentiment", F.round("avg_sentiment", 6)
    )


def sentiment_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.mean_sentiment(scored(spark, sf_dir)).select(F.round("avg_sentiment", 6).alias("avg_sentiment"))


def sentiment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.category_share(scored(spark, sf_dir)).withColumn("share", F.round("share", 6))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_metrics(scored(spark, sf_dir)).withColumn("avg_sentiment", F.round("avg_sentiment", 6))


def run_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tasks of a run scan the reviews, kept in memory and not: by the rows that their stages read."""
    folder = work_dir(spark, "tasks")
    texts = ingest.clean_reviews(table(spark, sf_dir, "documents"), "text")
    writers.write_parquet(texts, f"{folder}/clean")
    for kept in (True, False):
        run_analysis(spark, f"{folder}/clean", f"{folder}/kept={kept}", lexicon=corpus.LEXICON, keep_in_memory=kept)
    tasks = reduce(DataFrame.union, [
        spark.read.schema(metrics.TASK_SCHEMA).json(f"{folder}/kept={kept}/tasks/pct=*").withColumn("kept", F.lit(kept)) for kept in (True, False)
    ])
    total = readers.read_parquet(spark, f"{folder}/clean").count()
    return tasks.filter("task <> 'save'").select(
        "kept", "task", (F.col("input_rows") >= total).alias("scans")
    )


def fraction_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep_metrics(scored(spark, sf_dir), "doc_id").withColumn(
        "avg_sentiment", F.round("avg_sentiment", 6)
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_profile(documents(spark, sf_dir), "text", corpus.LEXICON)


def run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of runs: per user the longest time of two kinds of events."""
    base, other = corpus.COMPARED_MODES
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("task"), F.col("event_type").alias("mode"), F.col("value").alias("seconds")
    )
    compared = metrics.run_comparison(log, "task", "mode", "seconds", base, other)
    return compared.withColumn("speedup", F.round("speedup", 6))


# Windows, batch and stream


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream.scored_records(reviews(spark, sf_dir), corpus.LEXICON, corpus.KEYWORDS)
    return stream.windowed_words(dealt(rows, "review_id"))


def _epochs(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.unix_seconds(name) for name in ("window_start", "window_end")})


def window_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(_windowed(spark, sf_dir))


def window_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(windows.top_per_window(_windowed(spark, sf_dir)))


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps to epoch seconds and back, to the microsecond."""
    rows = table(spark, sf_dir, "events").select("event_id", epoch_seconds(utc("ts")).alias("send_time"))
    return rows.withColumn("send_us", F.unix_micros(event_time(F.col("send_time"))))


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "publish")
    rows = reviews(spark, sf_dir)
    feed.publish(feed.envelope(rows, "review_id", send_time=epoch_seconds(F.col("send_ts"))), path=folder)
    sent = readers.read_json_lines(spark, folder, "key string, value string")
    return _numbered(feed.good_records(feed.decode(sent))).select(
        "review_id", CLEAN_TEXT, F.unix_micros("send_ts").alias("send_us")
    )


def _numbered(records: DataFrame) -> DataFrame:
    """Ids travel as text; those of the documents are numbers."""
    return records.withColumn("review_id", F.col("review_id").cast("bigint"))


def _records(spark: SparkSession, folder: str, files: str = "feed") -> DataFrame:
    """The records that a feed's files hold, as a stream."""
    return feed.good_records(feed.decode(feed.read_feed(spark, f"{folder}/{files}")))


def _state(spark: SparkSession) -> dict:
    """No more state partitions than cores."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {"state_partitions": min(spark.sparkContext.defaultParallelism, shuffle)}


def _replayed(spark: SparkSession, sf_dir: str, folder: str, start: Callable[[], StreamingQuery], copies: int = 1) -> None:
    """The reviews in the order of their times, each step taken by a stream that goes on from its checkpoint."""
    steps = rounds(table(spark, sf_dir, "documents"))
    feed.replay(
        reviews(spark, sf_dir), "review_id", CLEAN_TEXT, "send_ts", f"{folder}/feed", steps, lambda: start().awaitTermination(),
        copies=copies, compression="snappy",
    )


def _fed(
    spark: SparkSession, sf_dir: str, folder: str, feed_run: FeedRun, copies: int = 1, start_again: bool = False
) -> None:
    """A run over the replayed reviews. One that may be stopped by a failure starts again from its checkpoint until it is done."""

    def start() -> None:
        while True:
            query = feed_run.start(feed.read_feed(spark, f"{folder}/feed"), f"{folder}/checkpoint")
            try:
                return query.awaitTermination()
            except StreamingQueryException:
                if not start_again:
                    raise

    feed.replay(
        reviews(spark, sf_dir), "review_id", CLEAN_TEXT, "send_ts", f"{folder}/feed", rounds(table(spark, sf_dir, "documents")), start, copies=copies
    )


def _scored_columns(records: DataFrame) -> DataFrame:
    return _numbered(records).select("review_id", CLEAN_TEXT, "send_us", "polarity", "category")


def window_top_words_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "stream")
    feed_run = FeedRun(f"{folder}/out", corpus.LEXICON, corpus.KEYWORDS, corpus.REPLAY_DELAY_SECONDS)
    _fed(spark, sf_dir, folder, feed_run)
    return _epochs(windows.read_window_documents(run.read_windows(spark, f"{folder}/out")))


def hashed_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long lexicon: every word of the documents, its polarity by a hash, with the corpus's modifiers and negations."""
    found = documents(spark, sf_dir).select(F.explode(letter_words(F.col("text"))).alias("word")).distinct()
    place = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint") % 2001
    others = scoring.lexicon_frame(spark, corpus.LEXICON).filter("polarity is null or intensity is not null or negates")
    modifiers, negations = others.filter("intensity is not null"), others.filter("negates")
    return scoring.lexicon_table(found.withColumn("polarity", (place - 1000) / F.lit(1000.0)), modifiers, negations)


def scored_records_large_lexicon_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed scored by a lexicon that no plan could carry, whose words meet each micro-batch's."""
    folder = work_dir(spark, "large-lexicon")
    writers.write_parquet(hashed_lexicon(spark, sf_dir), f"{folder}/lexicon")
    lexicon = readers.read_parquet(spark, f"{folder}/lexicon")
    _fed(spark, sf_dir, folder, FeedRun(f"{folder}/out", lexicon, corpus.KEYWORDS, corpus.REPLAY_DELAY_SECONDS))
    return _scored_columns(run.read_scored(spark, f"{folder}/out"))


def sentiment_scores_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.with_table_sentiment(documents(spark, sf_dir), "text", hashed_lexicon(spark, sf_dir))
    return rows.select("doc_id", "polarity", "category")


def crash_restart_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is sent twice, and the stream fails once after each of its sinks: each is scored once all the same."""
    folder = work_dir(spark, "crash")
    failures = ["_batches", "top_words", "_minutes", "_ids", "scored", "set_aside"]

    def fail(sink: str, number: int) -> None:
        if failures and sink == failures[-1]:
            failures.pop()
            raise RuntimeError(f"stopped after {sink} of batch {number}")

    feed_run = FeedRun(
        f"{folder}/out", corpus.LEXICON, corpus.KEYWORDS, corpus.REPLAY_DELAY_SECONDS, drop_repeats=True, after=fail
    )
    _fed(spark, sf_dir, folder, feed_run, copies=2, start_again=True)
    return _scored_columns(run.read_scored(spark, f"{folder}/out"))


def late_drops_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth review comes after all others: what the batches say that they read, kept and dropped as late."""
    folder = work_dir(spark, "late-drops")
    rows = reviews(spark, sf_dir)
    feed_run = FeedRun(f"{folder}/out", corpus.LEXICON, ("",), corpus.LATE_DELAY_SECONDS, drop_repeats=True)
    for late in (False, True):
        _send(rows.filter((F.col("review_id") % 10 == 0) == F.lit(late)), folder)
        feed_run.start(feed.read_feed(spark, f"{folder}/feed"), f"{folder}/checkpoint").awaitTermination()
    return run.batches(spark, f"{folder}/out").agg(*[F.sum(name).alias(name) for name in ("records", "kept", "late", "repeats")])


def scored_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "scored")

    def start() -> StreamingQuery:
        rows = stream.scored_records(_records(spark, folder), corpus.LEXICON, corpus.KEYWORDS)
        return stream.write_rows(rows, f"{folder}/out", f"{folder}/checkpoint", **_state(spark))

    _replayed(spark, sf_dir, folder, start)
    return _numbered(readers.read_parquet(spark, f"{folder}/out")).select(
        "review_id", CLEAN_TEXT, F.unix_micros("send_ts").alias("send_us"), "polarity", "category"
    )


def _unique(spark: SparkSession, folder: str, delay_seconds: int) -> StreamingQuery:
    rows = stream.without_repeats(_records(spark, folder), f"{delay_seconds} seconds")
    return stream.write_rows(rows, f"{folder}/out", f"{folder}/checkpoint", **_state(spark))


def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is sent twice and kept once."""
    folder = work_dir(spark, "dedup")
    _replayed(spark, sf_dir, folder, lambda: _unique(spark, folder, corpus.REPLAY_DELAY_SECONDS), copies=2)
    return _numbered(readers.read_parquet(spark, f"{folder}/out")).select("review_id", CLEAN_TEXT)


def _send(rows: DataFrame, folder: str) -> None:
    feed.publish(
        feed.envelope(rows, "review_id", send_time=epoch_seconds(F.col("send_ts"))), path=f"{folder}/feed"
    )


def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth review comes after all others: those beyond the delay are left out."""
    folder = work_dir(spark, "late")
    rows = reviews(spark, sf_dir)
    for late in (False, True):
        _send(rows.filter((F.col("review_id") % 10 == 0) == F.lit(late)), folder)
        _unique(spark, folder, corpus.LATE_DELAY_SECONDS).awaitTermination()
    return _numbered(readers.read_parquet(spark, f"{folder}/out")).select("review_id", CLEAN_TEXT)


def late_progress_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by Spark's own watermark: rows read, and rows dropped as late, from the log of the batches' progress."""
    folder = work_dir(spark, "late-progress")
    with ProgressLog(spark, f"{folder}/log"):
        late_rows = late_rows_stream(spark, sf_dir)
    kept = late_rows.agg(F.count(F.lit(1)).alias("kept"))
    dropped = read_progress(spark, f"{folder}/log").agg(F.sum("input_rows").alias("records"), F.sum("late_rows").alias("late"))
    return dropped.crossJoin(kept)  # one row each


def restart_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds are sent and the stream ends; then all are sent, and it goes on from its checkpoint: none is kept twice."""
    folder = work_dir(spark, "restart")
    rows = reviews(spark, sf_dir)
    for sent_again in (F.col("review_id") % 3 != 0, F.lit(True)):
        _send(rows.filter(sent_again), folder)
        _unique(spark, folder, corpus.WHOLE_FEED_SECONDS).awaitTermination()
    return _numbered(readers.read_parquet(spark, f"{folder}/out")).select("review_id", CLEAN_TEXT)


def pipeline_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines -> clean Parquet -> JSON lines -> feed, sent twice -> unique scored records, with no ids of their own."""
    folder = work_dir(spark, "whole")
    raw = table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.col("text").alias("reviewText"))).alias("value"))
    raw.write.text(f"{folder}/raw")
    ingest_raw(spark, f"{folder}/raw", f"{folder}/clean")
    convert.convert_new_files(spark, f"{folder}/clean", f"{folder}/json")
    for turn in ("first", "second"):
        feed.publish_new_files(
            spark, f"{folder}/json/data", "review_id", f"{folder}/{turn}", schema=f"review_id string, {CLEAN_TEXT} string",
            path=f"{folder}/feed/{turn}",
        )
    wanted = stream.wanted_records(
        _records(spark, folder, "feed/*"), corpus.KEYWORDS, repeats_within=f"{corpus.WHOLE_FEED_SECONDS} seconds"
    )
    rows = with_sentiment(wanted, CLEAN_TEXT, corpus.LEXICON)
    stream.write_rows(rows, f"{folder}/out", f"{folder}/checkpoint", **_state(spark)).awaitTermination()
    return readers.read_parquet(spark, f"{folder}/out").select(CLEAN_TEXT, "polarity", "category")


def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of reviews, markup (no JSON), event properties (JSON without a text) and reviews without an id."""
    folder = work_dir(spark, "quarantine")
    good = feed.envelope(
        reviews(spark, sf_dir), "review_id", send_time=epoch_seconds(F.col("send_ts"))
    ).select("value")
    markup = table(spark, sf_dir, "pages").select(F.col("html").alias("value"))
    other = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    nameless = table(spark, sf_dir, "benchmark").select(
        F.to_json(F.struct(F.col("text").alias(CLEAN_TEXT), F.lit(0.5).alias("send_time"))).alias("value")
    )
    mixed = good.unionByName(markup).unionByName(other).unionByName(nameless).withColumn("key", F.lit("0"))
    feed.publish(mixed.select("key", "value"), path=f"{folder}/feed")
    decoded = feed.decode(feed.read_feed(spark, f"{folder}/feed"))
    stream.write_rows(
        feed.quarantined(decoded), f"{folder}/bad", f"{folder}/checkpoint", **_state(spark)
    ).awaitTermination()
    return readers.read_parquet(spark, f"{folder}/bad").select("value", "problem")


def publish_new_files_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean JSON files sent on as records, a bounded number per micro-batch, each file once."""
    folder = work_dir(spark, "resend")
    rows = ingest.clean_reviews(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    writers.write_json_lines(rows.withColumnRenamed("doc_id", "review_id"), f"{folder}/source")
    for _ in range(2):
        feed.publish_new_files(
            spark, f"{folder}/source", "review_id", f"{folder}/checkpoint", path=f"{folder}/sent"
        )
    sent = readers.read_json_lines(spark, f"{folder}/sent", "key string, value string")
    return _numbered(feed.good_records(feed.decode(sent))).select("review_id", CLEAN_TEXT)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        ingest_clean, ingest_json, malformed_lines, ingest_quarantine, json_glob, incremental_convert, mixed_files_convert,
        incremental_convert_stream, report_json, output_size, source_files, partition_report,
        exclude_texts, keyword_filter, keyword_filter_whole_word, default_keyword_filter, keyword_table_filter,
        sample_fraction, bernoulli_sample, bernoulli_sample_all,
        word_frequency, word_frequency_sorted, word_frequency_with_empty, word_frequency_stripped,
        word_frequency_stop_table, top_words, top_words_limited, row_limit_words,
        stream_word_frequency,
        fraction_sweep, fraction_sweep_range_join, fraction_tables,
        sentiment_scores, sentiment_scores_arrow, sentiment_scores_join,
        sentiment_scores_salted, sentiment_counts, sentiment_counts_limited, row_limit_metrics,
        sentiment_mean, sentiment_share, run_metrics, run_tasks, fraction_metrics, profile, run_compare,
        window_word_counts, window_top_words, event_times, publish_roundtrip,
        window_top_words_stream, scored_records_stream, scored_records_large_lexicon_stream, sentiment_scores_large_lexicon,
        dedup_stream, late_rows_stream, late_drops_stream, late_progress_stream, restart_stream, crash_restart_stream,
        quarantine_stream, publish_new_files_stream, pipeline_stream,
    )
}
