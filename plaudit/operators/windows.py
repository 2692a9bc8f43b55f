"""Word counts over sliding event-time windows. The same functions serve batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.functions import presets
from plaudit.sizing import PART_BYTES, dealt

MEASURES = ("total", *presets.CATEGORIES)


def _span(seconds: int) -> str:
    return f"{seconds} seconds"


def sliding_word_counts(
    words: DataFrame,
    time: str = "send_ts",
    window_seconds: int = presets.WINDOW_SECONDS,
    slide_seconds: int = presets.SLIDE_SECONDS,
    per_slide: bool = True,
) -> DataFrame:
    """(window, word, total, positive, negative, neutral) from rows (time, word, category).

    A row belongs to window/slide windows. With ``per_slide`` rows are counted per slide
    first and only those counts are copied into the windows, so the copies cost
    vocabulary, not text; on a stream the windows' state is then touched once per slide,
    not once per micro-batch. That needs a window made of whole slides. Otherwise rows
    are copied, which saves a shuffle, and on a stream a state store: better where
    words seldom repeat within a slide, or a micro-batch spans many slides.
    """
    counts = [F.count("*").alias("total")] + [
        F.count_if(F.col("category") == name).alias(name) for name in presets.CATEGORIES
    ]
    if not per_slide or window_seconds % slide_seconds:
        span = F.window(time, _span(window_seconds), _span(slide_seconds))
        return words.groupBy(span.alias("window"), "word").agg(*counts)
    per_slide = words.groupBy(F.window(time, _span(slide_seconds)).alias("slide"), "word").agg(*counts)
    if window_seconds == slide_seconds:
        return per_slide.withColumnRenamed("slide", "window")
    if words.isStreaming:
        span = F.window("slide", _span(window_seconds), _span(slide_seconds))
    else:
        # All counts of a word meet in one task, so that their copies need no further shuffle; the parts are as much smaller as there are copies.
        copies = window_seconds // slide_seconds
        per_slide = dealt(per_slide, "word", part_bytes=PART_BYTES // copies)
        starts = [F.col("slide.start") - F.expr(f"INTERVAL {back * slide_seconds} SECONDS") for back in range(copies)]
        ends = [start + F.expr(f"INTERVAL {window_seconds} SECONDS") for start in starts]
        spans = [F.struct(start.alias("start"), end.alias("end")) for start, end in zip(starts, ends)]
        per_slide = per_slide.withColumn("span", F.explode(F.array(*spans)))
        span = F.col("span")
    return per_slide.groupBy(span.alias("window"), "word").agg(*[F.sum(name).alias(name) for name in MEASURES])


def flat_windows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "word", *MEASURES
    )


def top_per_window(flat: DataFrame, k: int = presets.WINDOW_TOP_WORDS) -> DataFrame:
    """The k most frequent words of each window, ties by word, with their rank.

    Each task keeps its own best k per window before the shuffle, so a window that
    holds most of the vocabulary does not end up whole in one task.
    """
    order = Window.partitionBy("window_start", "window_end").orderBy(F.desc("total"), F.asc("word"))
    return (
        flat.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


def top_of_parts(
    counts: DataFrame, k: int, window_seconds: int, slide_seconds: int, after_us: int | None = None, until_us: int | None = None
) -> DataFrame:
    """The k most frequent words that each partition has of each window, from counts (slide, word, measures) per slide.

    All counts of a word must lie in one partition, of bounded size: its totals are whole there, and only k rows per window leave it.
    Windows are those of whole slides that end after ``after_us`` and not after ``until_us``.
    """
    columns = ("slide", "word", *MEASURES)
    schema = ", ".join(["start bigint", "word string", *[f"{name} bigint" for name in MEASURES]])
    best = _part_tops(MEASURES, k, window_seconds // slide_seconds, slide_seconds, after_us, until_us)
    flat = counts.select(*columns).filter(F.col("slide").isNotNull() & F.col("word").isNotNull()).mapInArrow(best, schema)
    return flat.select(
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + window_seconds).alias("window_end"), "word", *MEASURES,
    )


def _part_tops(measures: tuple[str, ...], k: int, copies: int, slide_seconds: int, after_us: int | None, until_us: int | None) -> Callable:
    """A partition's best words per window, made here so that it travels by value."""
    micros = slide_seconds * 1_000_000

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [batch for batch in batches if batch.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        coded = pa.concat_arrays(table["word"].chunks).dictionary_encode()
        by_name = pc.sort_indices(coded.dictionary)
        names, place_of = coded.dictionary.take(by_name), np.empty(len(by_name), np.int64)
        place_of[by_name.to_numpy()] = np.arange(len(names))
        word = place_of[coded.indices.to_numpy()]
        slide = table["slide"].to_numpy() // slide_seconds
        values = [table[name].to_numpy() for name in measures]
        first = slide.min() - copies
        keys, places = [], []
        for back in range(copies):  # a slide's counts belong to the windows that start at it and before
            start = slide - back
            ends = (start + copies) * micros
            ending = np.ones(len(ends), bool) if after_us is None else ends > after_us
            if until_us is not None:
                ending &= ends <= until_us
            (place,) = np.nonzero(ending)
            keys.append((start[place] - first) * len(names) + word[place])
            places.append(place)
        key, place = np.concatenate(keys), np.concatenate(places)
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])  # of a window's word
        start = key[begin] // len(names)
        # Words stand in their order within a window, and keep it where totals are equal.
        ranked = np.lexsort((-np.add.reduceat(values[0][place], begin), start))
        head = np.flatnonzero(np.r_[True, start[1:] != start[:-1]])
        rank = np.arange(len(ranked)) - np.repeat(head, np.diff(np.r_[head, len(ranked)]))
        taken = ranked[rank < k]
        length = np.r_[begin[1:], len(key)][taken] - begin[taken]
        offset = np.cumsum(length) - length
        members = place[np.repeat(begin[taken] - offset, length) + np.arange(length.sum())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((start[taken] + first) * slide_seconds), names.take(pa.array(key[begin[taken]] % len(names))),
                *[pa.array(np.add.reduceat(value[members], offset)) for value in values],
            ],
            ["start", "word", *measures],
        )

    return tops


def window_documents(top: DataFrame) -> DataFrame:
    """One nested document per window; at most k words each."""
    entry = F.struct(
        F.col("rank"),
        F.col("word"),
        F.col("total").alias("count"),
        F.struct(*presets.CATEGORIES).alias("sentiment_breakdown"),
    )
    listed = top.groupBy("window_start", "window_end").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    words = F.transform(
        "_entries", lambda e: F.struct(e["word"], e["count"], e["sentiment_breakdown"])
    )
    return listed.select("window_start", "window_end", words.alias("top_words"))


def read_window_documents(documents: DataFrame) -> DataFrame:
    """Nested documents back to flat rows."""
    return documents.select(
        "window_start", "window_end", F.posexplode("top_words").alias("_pos", "e")
    ).select(
        "window_start",
        "window_end",
        F.col("e.word").alias("word"),
        F.col("e.count").alias("total"),
        *[F.col(f"e.sentiment_breakdown.{name}").alias(name) for name in presets.CATEGORIES],
        (F.col("_pos") + 1).cast("bigint").alias("rank"),
    )
