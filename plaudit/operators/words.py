"""Word rows, word counts and top words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions import presets
from plaudit.functions.text import batch_tokens, strip_punctuation


def word_rows(
    df: DataFrame,
    text: str,
    keep: Iterable[str] = (),
    tokens: Callable[[Column], Column] = batch_tokens,
    stop_words: Iterable[str] = presets.ENGLISH_STOP_WORDS,
    keep_empty: bool = False,
    strip_punct: bool = False,
) -> DataFrame:
    """One row per word of the text, with the ``keep`` columns beside it.

    Stop words go by an in-memory set test inside the generated code. Works on
    batch and streaming input.
    """
    rows = df.select(*keep, F.explode(tokens(F.col(text))).alias("word"))
    if strip_punct:
        rows = rows.withColumn("word", strip_punctuation(F.col("word")))
    if not keep_empty:
        rows = rows.filter(F.col("word") != "")
    stop = sorted({word.lower() for word in stop_words})
    return rows.filter(~F.col("word").isin(stop)) if stop else rows


def drop_words(words: DataFrame, stop_table: DataFrame) -> DataFrame:
    """Exclude the words of a table: for stop lists too long to write into the plan.

    The words are counted before they meet the table, so a hot word enters the join
    once and not once per occurrence.
    """
    counts = words.groupBy("word").agg(F.count("*").alias("frequency"))
    return counts.join(stop_table.select("word").distinct(), "word", "left_anti")


def word_frequency(words: DataFrame) -> DataFrame:
    """(word, frequency). Partial counts are built before the shuffle, so a hot word is cheap."""
    return words.groupBy("word").agg(F.count("*").alias("frequency"))


def ranked(frequency: DataFrame) -> DataFrame:
    """Most frequent first, ties by word: a full distributed sort."""
    return frequency.orderBy(F.desc("frequency"), F.asc("word"))


def top_words(frequency: DataFrame, k: int = presets.TOP_WORDS) -> DataFrame:
    """The k most frequent words, ties by word; each task keeps only its own best k."""
    return ranked(frequency).limit(k)
