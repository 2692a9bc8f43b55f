"""Sentiment as joins, and what is counted from it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plaudit.functions import presets
from plaudit.functions.sentiment import (
    IN_MEMORY_WORDS,
    LEXICON_SCHEMA,
    Lexicon,
    category,
    hit_units,
    is_negated,
    mean_polarity,
    plain_scorer,
    with_neighbours,
    with_sentiment,
)
from plaudit.functions.text import counted_label, letter_words
from plaudit.sources.readers import in_memory
from plaudit.sizing import BROADCAST_MAX_ROWS, is_small, lookup_join

#: Text that shares the words of a lexicon table, and the least that is worth a task of its own.
CHUNK_BYTES = 32 << 20
LEAST_CHUNK_BYTES = 1 << 20


def lexicon_frame(spark: SparkSession, lexicon: Lexicon) -> DataFrame:
    return in_memory(spark, lexicon.rows(), LEXICON_SCHEMA)


def lexicon_table(
    words: DataFrame, modifiers: DataFrame | None = None, negations: DataFrame | None = None
) -> DataFrame:
    """One row per word from (word, polarity), (word, intensity) and (word) tables.

    A word listed with several polarities gets their mean.
    """
    parts = words.selectExpr(
        "lower(word) word", "cast(polarity as double) polarity", "cast(null as double) intensity", "false negates"
    )
    if modifiers is not None:
        parts = parts.unionByName(
            modifiers.selectExpr(
                "lower(word) word", "cast(null as double) polarity", "cast(intensity as double) intensity", "false negates"
            )
        )
    if negations is not None:
        parts = parts.unionByName(
            negations.selectExpr(
                "lower(word) word", "cast(null as double) polarity", "cast(null as double) intensity", "true negates"
            )
        )
    return parts.groupBy("word").agg(
        F.avg("polarity").alias("polarity"),
        F.max("intensity").alias("intensity"),
        F.max("negates").alias("negates"),
    )


def score_by_join(
    df: DataFrame,
    key: str,
    text: str,
    table: DataFrame,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """(key, polarity, category) for every row, with the lexicon as a table of any size.

    Each word carries its two predecessors, so no window is needed. Words of the corpus meet the
    words with a polarity in an inner join; only known words go on to the modifiers and negations, a
    part of the table with its own size check. A text's words lie in one task, where they
    shrink to one (key, sum, hits) row before the shuffle; the text itself never
    moves. Texts without known words come back by key, which must not be null.
    """
    words = (
        df.select(key, letter_words(F.col(text)).alias("_words"))
        .select(key, F.explode(with_neighbours(F.col("_words"))).alias("x"))
        .select(key, F.col("x.w").alias("w"), F.col("x.p1").alias("p1"), F.col("x.p2").alias("p2"))
        .filter(F.col("w").isNotNull())
    )
    opinions = table.filter(F.col("polarity").isNotNull())
    before = table.filter(F.col("intensity").isNotNull() | F.col("negates"))
    few_opinions, few_before = (is_small(side, max_broadcast_rows) for side in (opinions, before))

    def lookup(rows: DataFrame, side: DataFrame, column: str, small: bool, how: str, **wanted: str) -> DataFrame:
        values = [F.col(source).alias(name) for name, source in wanted.items()]
        return lookup_join(rows, side.select(F.col("word").alias(column), *values), column, key, small, how)

    known = lookup(words, opinions, "w", few_opinions, "inner", _polarity="polarity")
    known = lookup(known, before, "p1", few_before, "left", _intensity="intensity", _neg1="negates")
    known = lookup(known, before, "p2", few_before, "left", _neg2="negates")
    negated = is_negated(
        F.coalesce("_neg1", F.lit(False)),
        F.col("_intensity").isNotNull(),
        F.coalesce("p1", F.lit("")),
        F.coalesce("_neg2", F.lit(False)),
    )
    units = hit_units(F.col("_polarity"), F.coalesce("_intensity", F.lit(1.0)), negated)
    sums = (
        known.select(key, units.alias("_units"))
        .groupBy(key)
        .agg(F.sum("_units").alias("_sum"), F.count("_units").alias("_hits"))
    )
    return (
        df.select(key)
        .join(sums, key, "left")
        .select(key, F.coalesce(mean_polarity(F.col("_sum"), F.col("_hits")), F.lit(0.0)).alias("polarity"))
        .withColumn("category", category(F.col("polarity")))
    )


def occurring_words(df: DataFrame, text: str, table: DataFrame, *by: str) -> DataFrame:
    """The part of a lexicon table whose words occur in the texts, for each value of ``by``. Each word meets the table once, however often it occurs.

    Both sides are sorted: neither goes through the driver as a broadcast, small as its files may be.
    """
    words = df.select(*by, F.explode(letter_words(F.col(text))).alias("word")).distinct()
    return words.join(table.hint("merge"), "word")


def with_table_sentiment(
    df: DataFrame, text: str, table: DataFrame, max_words: int = IN_MEMORY_WORDS, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Add ``polarity`` and ``category`` by a lexicon table of any size.

    Of the table only the words that occur in the texts matter. If the texts are one chunk and hold at most ``max_words`` of them, these are fetched
    and travel with the tasks as dictionaries: texts stay in place, and nothing is joined. Otherwise each chunk of the texts gets the words
    that occur in it: they meet the table once per chunk, and the texts wait for them sorted by chunk, so a task
    holds the words of one chunk at a time and the driver none.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if size <= chunk_bytes:
        found = occurring_words(df, text, table).select("word", "polarity", "intensity", "negates").limit(max_words + 1).collect()
        if len(found) <= max_words:
            return with_sentiment(df, text, Lexicon.from_rows(found), form="arrow")
    cores = df.sparkSession.sparkContext.defaultParallelism
    chunks = max(-(-size // chunk_bytes), min(cores, -(-size // LEAST_CHUNK_BYTES)), 1)
    # By all columns: copies of a text lie in one chunk only if their whole rows are the same.
    hashed = [field.name for field in df.schema if "map<" not in field.dataType.simpleString()]
    chunk = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in hashed]), F.lit(chunks)).cast("int")
    texts = df.select(F.lit(1).alias("_kind"), chunk.alias("_chunk"), F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row"))
    placed = df.select(chunk.alias("_chunk"), F.col(text).alias("_text")).repartition(chunks, "_chunk")
    opinions = table.select("word", "polarity", "intensity", "negates")
    entries = occurring_words(placed, "_text", opinions, "_chunk").withColumn("_kind", F.lit(0))
    together = entries.unionByName(texts, allowMissingColumns=True).repartition(chunks, "_chunk").sortWithinPartitions("_chunk", "_kind")
    scored = together.select(
        "_chunk", "word", "polarity", "intensity", "negates", "_row", letter_words(F.col("_row").getField(text)).alias("_words")
    ).mapInArrow(_chunk_scores(), T.StructType([*df.schema.fields, T.StructField("polarity", T.DoubleType())]))
    return scored.withColumn("category", category(F.col("polarity")))


def _chunk_scores() -> Callable:
    """Rows with their polarity from batches sorted by chunk, in which a chunk's words (with their values) come before its rows."""
    text_polarity = plain_scorer()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, polarity, intensity, negating = None, {}, {}, set()
        for batch in batches:
            rows, words = batch.column("_row"), batch.column("_words")
            values = [batch.column(name).to_pylist() for name in ("_chunk", "word", "polarity", "intensity", "negates")]
            places, scores = [], []
            for place, (chunk, word, value, factor, negates) in enumerate(zip(*values)):
                if chunk != current:
                    current, polarity, intensity, negating = chunk, {}, {}, set()
                if word is None:
                    places.append(place)
                    scores.append(text_polarity(words[place].as_py(), polarity, intensity, negating))
                    continue
                if value is not None:
                    polarity[word] = value
                if factor is not None:
                    intensity[word] = factor
                if negates:
                    negating.add(word)
            if places:
                taken = rows.take(pa.array(places))
                yield pa.RecordBatch.from_arrays(
                    [*taken.flatten(), pa.array(scores, pa.float64())], [*[field.name for field in taken.type], "polarity"]
                )

    return score


def _category_count(name: str):
    return F.count_if(F.col("category") == name)


def category_counts(scored: DataFrame) -> DataFrame:
    """(category, count) with all three categories, also those that did not occur."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("category"), F.col(f"n_{name}").alias("count")) for name in presets.CATEGORIES]
    )
    return scored.agg(*[_category_count(name).alias(f"n_{name}") for name in presets.CATEGORIES]).select(
        F.inline(pairs)
    )


def mean_sentiment(scored: DataFrame) -> DataFrame:
    """One row: the mean polarity, 0.0 without rows."""
    return scored.agg(F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("avg_sentiment"))


def category_share(scored: DataFrame) -> DataFrame:
    """(category, count, share, label): the numbers of a share chart."""
    total = sum((F.col(f"n_{name}") for name in presets.CATEGORIES[1:]), F.col(f"n_{presets.CATEGORIES[0]}"))
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("category"),
                F.col(f"n_{name}").alias("count"),
                F.when(total > 0, F.col(f"n_{name}") / total).otherwise(F.lit(0.0)).alias("share"),
                counted_label(F.lit(name), F.col(f"n_{name}")).alias("label"),
            )
            for name in presets.CATEGORIES
        ]
    )
    return scored.agg(*[_category_count(name).alias(f"n_{name}") for name in presets.CATEGORIES]).select(
        F.inline(pairs)
    )
