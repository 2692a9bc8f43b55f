"""Samples, limits and the sweep over several sample sizes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions import presets
from plaudit.operators.words import word_rows


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Keep each row with the given probability. Depends on how the rows are partitioned."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_percent(key: str) -> Column:
    """A row's place in 0..99, from its key alone; a row without a key has the place of the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def checked_percents(percents: Iterable[int]) -> list[int]:
    """The sample sizes in order, each once; a size outside 0 to 100 is an error."""
    sizes = sorted(set(percents))
    if any(not 0 <= size <= 100 for size in sizes):
        raise ValueError(f"sample sizes are whole percents from 0 to 100, not {sizes}")
    return sizes


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """A reproducible sample: the same rows for every partitioning, smaller ones inside larger ones."""
    return df.filter(hash_percent(key) < checked_percents([percent])[0])


#: Keys that a round draws for each span to place its bounds, about so many bounds of a round, and keys of a span that are at last ordered.
KEY_SAMPLE, BOUNDS, LAST_KEYS = 10_000, 255, 10_000


def _bucket(key: Column, bounds: list) -> Column:
    """A key's place among sorted bounds: 2 i below bound i and above the one before it, 2 i + 1 at it. A tree of comparisons."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        bound = F.lit(bounds[middle])
        return (
            F.when(key < bound, between(low, middle)).when(key == bound, F.lit(2 * middle + 1)).otherwise(between(middle + 1, high))
        )

    return between(0, len(bounds))


def _inside(key: Column, span: tuple) -> Column:
    """Whether a key lies strictly between two bounds, of which None is none."""
    low, high = span
    above = F.lit(True) if low is None else key > F.lit(low)
    return above if high is None else above & (key < F.lit(high))


def nth_keys(df: DataFrame, key: str, places: Iterable[int]) -> dict:
    """{n: the n-th smallest key, or None if there are no more than n}, all places together.

    Each round draws a bounded sample of the keys that are still in question, cuts them at about ``BOUNDS`` of it, and counts the
    keys between and at the bounds: counts alone are shuffled. A key that many rows share is a bound with its own count. A
    span of at most ``LAST_KEYS`` keys is fetched and ordered. A table of 10^11 keys takes three rounds for one limit, five for five.
    """
    keys = df.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull())
    column, total = F.col("_key"), keys.count()
    found = {n: None for n in places}
    # Places that are open: n -> (span, number of keys in it, place in it from 1).
    left = {n: ((None, None), total, n) for n in found if 0 < n < total}
    seed = 0
    while left:
        seed += 1
        small = {n: at for n, at in left.items() if at[1] <= LAST_KEYS}
        if small:
            wanted = reduce(or_, [_inside(column, span) for span in {at[0] for at in small.values()}])
            last = sorted(row[0] for row in keys.filter(wanted).collect())
            for n, (span, _, place) in small.items():
                low, high = span
                found[n] = [k for k in last if (low is None or k > low) and (high is None or k < high)][place - 1]
            left = {n: at for n, at in left.items() if n not in small}
            continue
        spans = {at[0]: at[1] for at in left.values()}
        wanted = keys.filter(reduce(or_, [_inside(column, span) for span in spans]))
        share = min(1.0, KEY_SAMPLE * len(spans) / sum(spans.values()))
        drawn = sorted({row[0] for row in wanted.sample(share, seed=seed).limit(2 * KEY_SAMPLE * len(spans)).collect()})
        step = max(1, len(drawn) // BOUNDS)
        bounds = drawn[::step]
        edges = sorted({bound for span in spans for bound in span if bound is not None} | set(bounds))
        counted = {row[0]: row[1] for row in wanted.groupBy(_bucket(column, edges)).agg(F.count(F.lit(1))).collect()}
        for n, (span, _, place) in list(left.items()):
            first = 0 if span[0] is None else 2 * edges.index(span[0]) + 2
            for bucket in range(first, 2 * len(edges) + 1):
                size = counted.get(bucket, 0)
                if place <= size:
                    break
                place -= size
            i, at_bound = divmod(bucket, 2)
            if at_bound:
                found[n] = edges[i]
                del left[n]
            else:
                low, high = edges[i - 1] if i else None, edges[i] if i < len(edges) else None
                left[n] = ((low, high), size, place)
    return found


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest (unique) keys; rows without a key have no place and are not among them.

    Only counts of keys travel to find the n-th one; the texts stay in place and the bound
    reaches the scan as a filter.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    last = nth_keys(df, key, [n])[n]
    return df.filter(F.col(key).isNotNull() if last is None else F.col(key) <= F.lit(last))


def smallest_level(key: str, percents: Iterable[int]) -> Column:
    """The smallest sample size that contains the row; null if none does."""
    place = hash_percent(key)
    return F.coalesce(*[F.when(place < percent, F.lit(percent)) for percent in checked_percents(percents)])


def smallest_limit(df: DataFrame, key: str, limits: dict[int, int]) -> Column:
    """The smallest label of ``limits`` (label: first rows by key) that contains the row; null if none does."""
    ends = nth_keys(df, key, limits.values())

    def within(n: int) -> Column:
        if n <= 0:
            return F.lit(False)
        return F.col(key).isNotNull() if ends[n] is None else F.col(key) <= F.lit(ends[n])

    return F.coalesce(*[F.when(within(n), F.lit(label)) for label, n in sorted(limits.items())])


def words_by_level(leveled: DataFrame, text: str, levels: Iterable[int], name: str = "pct", **word_options) -> DataFrame:
    """(pct, word, frequency) for rows marked with ``_level``, the smallest sample that holds them.

    A row is counted once, under its level. The counts of all samples sit side by side on the word, so
    the running sums need no second shuffle.
    """
    levels = sorted(set(levels))
    words = word_rows(leveled.filter(F.col("_level").isNotNull()), text, keep=["_level"], **word_options)
    counted = words.groupBy("word").agg(
        *[F.count_if(F.col("_level") <= level).alias(f"n_{level}") for level in levels]
    )
    pairs = F.array(
        *[F.struct(F.lit(level).alias(name), F.col(f"n_{level}").alias("frequency")) for level in levels]
    )
    return counted.select("word", F.inline(pairs)).filter(F.col("frequency") > 0).select(name, "word", "frequency")


def sweep_word_frequency(
    df: DataFrame, key: str, text: str, percents: Iterable[int] = presets.FRACTIONS, **word_options
) -> DataFrame:
    """(pct, word, frequency) for every sample size, from one scan and one shuffle."""
    percents = checked_percents(percents)
    return words_by_level(df.withColumn("_level", smallest_level(key, percents)), text, percents, **word_options)


def sweep_limits(
    df: DataFrame, key: str, text: str, limits: dict[int, int] = presets.ROW_LIMITS, **word_options
) -> DataFrame:
    """(pct, word, frequency) for every row limit, from one scan and one shuffle after the bounds are found."""
    return words_by_level(df.withColumn("_level", smallest_limit(df, key, limits)), text, limits, **word_options)


def sweep_by_range_join(
    df: DataFrame, key: str, text: str, fractions: DataFrame, **word_options
) -> DataFrame:
    """The same sweep for sample sizes given as a table ``fractions(pct)``.

    Each of the 100 places is given the smallest size that holds it; texts are counted per (size, word), and only
    those counts meet the sizes in the range join. A size that is null or outside 0 to 100 is an error.
    """
    size = F.col("pct").cast("int")
    # Sizes are whole percents, so at most 101 rows are broadcast, whatever the table holds.
    sizes = fractions.select(
        F.when(size.between(0, 100), size)
        .otherwise(F.raise_error(F.concat(F.lit("no whole percent from 0 to 100: "), F.coalesce(size.cast("string"), F.lit("null")))))
        .cast("int").alias("pct")
    ).distinct()
    places = df.sparkSession.range(100).select(F.col("id").alias("_place"))
    levels = places.join(F.broadcast(sizes), F.col("_place") < F.col("pct")).groupBy("_place").agg(
        F.min("pct").alias("_level")
    )
    leveled = df.withColumn("_place", hash_percent(key)).join(F.broadcast(levels), "_place")
    counted = word_rows(leveled, text, keep=["_level"], **word_options).groupBy("_level", "word").agg(
        F.count("*").alias("n")
    )
    return (
        counted.join(F.broadcast(sizes), F.col("_level") <= F.col("pct"))
        .groupBy("pct", "word")
        .agg(F.sum("n").alias("frequency"))
    )
