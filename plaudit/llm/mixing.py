"""Mixing sources to target weights, with DataFrame functions only.

Words are summed per source, a target is set for each, and each document comes floor(rate)
times plus one copy drawn with probability equal to the fraction, rate being target / size
of its source. Draws hash the document id with a seed, so that reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, the last one;
sources without words get target 0 and no copies; rows of the same id share their draw; an
empty table gives an empty result; other columns are kept and none of theirs is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.llm.common import WORD, uniform
from plaudit.sizing import is_small, lookup_join

#: Weights of the sources in code point order, repeating (fixed values).
WEIGHTS = (5, 2, 1)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, size) -> with the words each source is to give.

    The total is shared by weight; a target stops at ``most`` times its source's size and the
    excess is shared again. Ordered by size / weight, the sources that stop come
    first: with the k smallest stopped, the others get (total - their limits) / (weights left)
    per unit of weight, and the level reached is the largest of these. One row per
    source is ordered here, in one task; documents are not.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    places = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn(
        "_weight", F.element_at(places, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("_limit", F.col("source_size") * most)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before).cast("double") / left.cast("double")
    leveled = ranked.withColumn("_level", level).withColumn("_top", F.max("_level").over(everything))
    return leveled.select(
        "source", "source_size",
        F.least(F.col("_top") * F.col("_weight"), F.col("_limit").cast("double")).alias("target"),
    )


def mixed(
    docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = 3,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", columns: tuple[str, ...] = (),
) -> DataFrame:
    """(columns..., _mix: struct of size, source_size, target, copies) for every document."""
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    rows = docs.select(
        *dict.fromkeys((doc_id, *columns)), word_count(text).alias("_size"), key.alias("_source_key")
    )
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(word_count(text)).alias("source_size"))
    targets = source_targets(sizes, weights, most).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source_key"),
        F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
    )
    joined = lookup_join(rows, targets, "_source_key", doc_id, small=is_small(docs.select(source).distinct()))
    rate = F.when(
        F.col("_source_size") > 0, F.least(F.col("_target") / F.col("_source_size"), F.lit(float(most)))
    ).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    drawn = uniform(F.col(doc_id), seed=seed) < rate - whole
    return joined.select(
        *dict.fromkeys((doc_id, *columns)),
        F.struct(
            F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
            F.col("_target").alias("target"), (whole + drawn.cast("bigint")).cast("bigint").alias("copies"),
        ).alias("_mix"),
    )


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mixed documents themselves: each row as many times as the mix takes it."""
    kept = tuple(docs.columns)
    rows = mixed(docs, seed, columns=kept, **options).filter(F.col("_mix.copies") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col("_mix.copies").cast("int")))
    return rows.withColumn("_copy", copies).select(*kept)
