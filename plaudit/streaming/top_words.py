"""Streaming analysis: keyword filter, sentiment, top words per sliding window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from plaudit.functions import presets
from plaudit.functions.sentiment import Lexicon, with_sentiment
from plaudit.functions.text import matches_keyword, stream_tokens
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.operators.windows import flat_windows, sliding_word_counts, top_per_window, window_documents
from plaudit.operators.words import word_rows
from plaudit.session import ROCKSDB_STATE
from plaudit.streaming.feed import start_stream


def without_repeats(
    records: DataFrame, delay: str, time: str = "send_ts", key: str = "review_id", salts: int = 8
) -> DataFrame:
    """Drop records sent again within the delay of the first; state is kept no longer.

    One record may be sent so often that its copies outweigh all others. They are first
    thinned out under (key, salt) by several tasks; at most ``salts`` of them meet
    under the key. With ``salts=1`` the first step is left out.
    """
    marked = records.withWatermark(time, delay)
    if salts > 1:
        salt = F.floor(F.rand(seed=17) * salts).cast("int")
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])


def scored_records(
    records: DataFrame,
    lexicon: Lexicon | None = None,
    keywords: Iterable[str] = presets.STREAM_KEYWORDS,
    text: str = CLEAN_TEXT,
    whole_word: bool = False,
) -> DataFrame:
    """Records that hold a keyword, with polarity and category; no shuffle, no state."""
    return with_sentiment(records.filter(matches_keyword(F.col(text), keywords, whole_word)), text, lexicon)


def wanted_records(
    records: DataFrame,
    keywords: Iterable[str] = presets.STREAM_KEYWORDS,
    repeats_within: str | None = None,
    text: str = CLEAN_TEXT,
    whole_word: bool = False,
) -> DataFrame:
    """Records that hold a keyword, without repeats if a delay is given: the filter spares the state the others."""
    wanted = records.filter(matches_keyword(F.col(text), keywords, whole_word))
    return without_repeats(wanted, repeats_within) if repeats_within else wanted


def feed_words(
    scored: DataFrame,
    text: str = CLEAN_TEXT,
    time: str = "send_ts",
    stop_words: Iterable[str] = presets.STREAM_STOP_WORDS,
) -> DataFrame:
    """(time, category, word) rows of the scored feed."""
    return word_rows(scored, text, keep=[time, "category"], tokens=stream_tokens, stop_words=stop_words)


def windowed_words(
    scored: DataFrame,
    delay: str | None = None,
    time: str = "send_ts",
    window_seconds: int = presets.WINDOW_SECONDS,
    slide_seconds: int = presets.SLIDE_SECONDS,
    per_slide: bool = True,
    **word_options,
) -> DataFrame:
    """Words per sliding window with their sentiment breakdown, flat.

    On a stream ``delay`` sets the watermark: later rows are dropped and counted by
    Spark, and a window's state goes once the watermark passes its end.
    """
    if delay is not None:
        scored = scored.withWatermark(time, delay)
    words = feed_words(scored, time=time, **word_options)
    return flat_windows(sliding_word_counts(words, time, window_seconds, slide_seconds, per_slide))


def write_top_words(
    windows: DataFrame,
    folder: str,
    checkpoint: str,
    k: int = presets.WINDOW_TOP_WORDS,
    **start_options,
):
    """Write one nested document per finished window.

    In append mode all words of a window arrive in the same micro-batch, so ranking
    there is exact. A batch that runs again overwrites its own folder, named by its query's id, which is that of the
    checkpoint, and its number; an error fails the batch instead of losing the window.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        documents = window_documents(top_per_window(batch, k))
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        documents.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/run={run}/batch_id={batch_id}")

    conf = {**ROCKSDB_STATE, **start_options.pop("conf", {})}
    return start_stream(windows, checkpoint, lambda w: w.foreachBatch(write_batch), conf=conf, **start_options)


def write_rows(df: DataFrame, folder: str, checkpoint: str, format: str = "parquet", **start_options):
    """Append every row to files exactly once: scored records, quarantined records, unique records."""
    conf = {**ROCKSDB_STATE, **start_options.pop("conf", {})}
    return start_stream(
        df, checkpoint, lambda w: w.format(format).option("path", folder), conf=conf, **start_options
    )


DOCUMENT_SCHEMA = (
    "window_start timestamp, window_end timestamp, top_words array<struct<word: string, count: bigint, "
    "sentiment_breakdown: struct<positive: bigint, negative: bigint, neutral: bigint>>>"
)


def read_top_words(spark, folder: str) -> DataFrame:
    """All window documents written so far."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(f"{folder}/run=*/batch_id=*")
