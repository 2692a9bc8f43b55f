"""Word counts and sentiment of one input as a single plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plaudit.functions import presets
from plaudit.functions.sentiment import Lexicon, with_sentiment
from plaudit.functions.text import batch_tokens
from plaudit.sources.readers import in_memory


def text_profile(
    df: DataFrame,
    text: str,
    lexicon: Lexicon | None = None,
    k: int = presets.TOP_WORDS,
    stop_words: tuple[str, ...] = presets.ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Top words and category counts as one (task, key, value) table.

    Both tasks share one scan and one shuffle: each text yields its words and its
    category, counted in each task before they move. Words hold no space, so a
    leading one marks a category. Categories that did not occur come from a union
    with zero rows.
    """
    scored = with_sentiment(df.select(text), text, lexicon)
    skipped = ["", *sorted(stop_words)]
    ones = (
        scored.select(
            F.explode(F.concat(batch_tokens(F.col(text)), F.array(F.concat(F.lit(" "), "category")))).alias("item")
        )
        .filter(~F.col("item").isin(skipped))
        .withColumn("n", F.lit(1).cast("bigint"))
    )
    zeros = in_memory(df.sparkSession, [(f" {name}", 0) for name in presets.CATEGORIES], "item string, n bigint")
    is_category = F.startswith("item", F.lit(" "))
    counts = (
        ones.unionByName(zeros)
        .groupBy("item")
        .agg(F.sum("n").alias("value"))
        .select(
            F.when(is_category, "sentiment").otherwise("words").alias("task"),
            F.ltrim("item").alias("key"),
            "value",
        )
    )
    # Each task keeps its own best rows before they move, so no group gathers whole.
    order = Window.partitionBy("task").orderBy(F.desc("value"), F.asc("key"))
    best = counts.withColumn("_rank", F.row_number().over(order)).filter(
        F.col("_rank") <= max(k, len(presets.CATEGORIES))
    )
    return best.filter((F.col("task") == "sentiment") | (F.col("_rank") <= k)).select("task", "key", "value")
