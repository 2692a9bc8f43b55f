"""Polarity of a text from word lists, as expressions that need no shuffle.

Rule: a known word counts with its polarity, times the intensity of the word before
it ("very good"), clipped to [-1, 1], times -0.5 if it is negated. It is negated if
the word before it negates, or the word two before negates and the one between is
an intensifier or a single letter ("not very good", "not a good"). The polarity of
a text is the mean over its known words, 0.0 if there is none.

Each known word contributes a whole number of millionths, so sums do not depend on
the order of the rows and every form of the scorer gives the same double.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions import presets
from plaudit.functions.text import letter_words

#: Words that a plan carries; a longer list is a table, for ``operators.scoring.score_by_join``.
IN_MEMORY_WORDS = 20_000


@dataclass(frozen=True)
class Lexicon:
    """Word lists small enough to travel with each task."""

    polarity: dict[str, float]
    intensity: dict[str, float] = field(default_factory=dict)
    negations: tuple[str, ...] = ()

    @classmethod
    def starter(cls) -> Lexicon:
        return cls(presets.STARTER_POLARITY, presets.STARTER_INTENSITY, presets.STARTER_NEGATIONS)

    @classmethod
    def from_table(cls, table: DataFrame, max_rows: int = IN_MEMORY_WORDS) -> Lexicon:
        """Fetch a table in the shape of :func:`lexicon_table`, if it is of bounded size."""
        rows = table.select("word", "polarity", "intensity", "negates").limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(
                f"more than {max_rows} words: score with operators.scoring.score_by_join instead"
            )
        return cls.from_rows(rows)

    @classmethod
    def from_rows(cls, rows: Iterable) -> Lexicon:
        return cls(
            {r.word: r.polarity for r in rows if r.polarity is not None},
            {r.word: r.intensity for r in rows if r.intensity is not None},
            tuple(sorted(r.word for r in rows if r.negates)),
        )

    def rows(self) -> list[tuple[str, float | None, float | None, bool]]:
        negating = set(self.negations)
        words = sorted({*self.polarity, *self.intensity, *negating})
        return [(w, self.polarity.get(w), self.intensity.get(w), w in negating) for w in words]


LEXICON_SCHEMA = "word string, polarity double, intensity double, negates boolean"


def hit_units(polarity: Column, intensity: Column, negated: Column) -> Column:
    """One known word's contribution in whole millionths."""
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), polarity * intensity))
    factor = F.when(negated, F.lit(presets.NEGATION_FACTOR)).otherwise(F.lit(1.0))
    return F.round(clipped * factor * F.lit(float(presets.SCORE_UNIT))).cast("bigint")


def mean_polarity(units: Column, hits: Column) -> Column:
    """Sum of millionths over known words to a polarity; 0.0 without any."""
    return F.when(hits > 0, units / (hits.cast("double") * F.lit(float(presets.SCORE_UNIT)))).otherwise(
        F.lit(0.0)
    )


def category(polarity: Column) -> Column:
    """Strict on both sides: exactly +0.05 or -0.05 is neutral."""
    return (
        F.when(polarity > presets.POSITIVE_ABOVE, "positive")
        .when(polarity < presets.NEGATIVE_BELOW, "negative")
        .otherwise("neutral")
    )


def with_neighbours(words: Column) -> Column:
    """Each word together with the two before it, as an array of structs (w, p1, p2).

    Shifting the array makes it longer than the words, so two entries without a word
    follow at the end, also for a text that has no words at all.
    """
    words = F.coalesce(words, F.array().cast("array<string>"))
    before = F.concat(F.array(F.lit("")), words)
    two_before = F.concat(F.array(F.lit(""), F.lit("")), words)
    return F.arrays_zip(words.alias("w"), before.alias("p1"), two_before.alias("p2"))


def is_negated(prev_negates: Column, prev_intensifies: Column, prev: Column, prev2_negates: Column) -> Column:
    return prev_negates | (prev2_negates & (prev_intensifies | (F.length(prev) == 1)))


def _one_of(word: Column, words: Iterable[str]) -> Column:
    words = list(words)
    return word.isin(words) if words else F.lit(False)


def _value_of(word: Column, values: dict[str, float], default: float) -> Column:
    """A lookup as one set test per distinct value."""
    by_value = defaultdict(list)
    for key, value in values.items():
        by_value[float(value)].append(key)
    chain = None
    for value, keys in sorted(by_value.items(), key=lambda item: -len(item[1])):
        chain = (F if chain is None else chain).when(word.isin(keys), F.lit(value))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def native_hits(words: Column, lexicon: Lexicon) -> Column:
    """The contributions of all known words, an ``array<bigint>``.

    ``words`` must be a plain column, not the tokeniser's expression: the words before a
    known one are fetched by position, which would cut the text again each time.
    """

    def units(word: Column, i: Column) -> Column:
        p1, p2 = (F.coalesce(F.get(words, i - back), F.lit("")) for back in (1, 2))
        negated = is_negated(
            _one_of(p1, lexicon.negations), _one_of(p1, lexicon.intensity), p1, _one_of(p2, lexicon.negations)
        )
        value = hit_units(
            _value_of(word, lexicon.polarity, 0.0), _value_of(p1, lexicon.intensity, 1.0), negated
        )
        return F.when(_one_of(word, lexicon.polarity), value)

    return F.filter(F.transform(words, units), lambda unit: unit.isNotNull())


def plain_scorer() -> Callable[..., float]:
    """The rule as a function of (words, polarity, intensity, negating), made here so that it travels by value."""
    factor, unit = presets.NEGATION_FACTOR, float(presets.SCORE_UNIT)

    def text_polarity(words: Iterable[str] | None, polarity: dict, intensity: dict, negating: set) -> float:
        total = hits = 0
        p1 = p2 = ""
        for word in () if words is None else words:
            value = polarity.get(word)
            if value is not None:
                negated = p1 in negating or (p2 in negating and (p1 in intensity or len(p1) == 1))
                value = max(-1.0, min(1.0, value * intensity.get(p1, 1.0)))
                value = value * (factor if negated else 1.0) * unit
                total += int(math.copysign(math.floor(abs(value) + 0.5), value))
                hits += 1
            p1, p2 = word, p1
        return float(total) / (hits * unit) if hits else 0.0

    return text_polarity


def arrow_polarity(words: Column, lexicon: Lexicon) -> Column:
    """The same rule on Arrow batches of the words that :func:`letter_words` cuts, so that all forms see the same.

    The function carries plain dictionaries only, so workers need no copy of this package.
    """
    polarity, intensity = dict(lexicon.polarity), dict(lexicon.intensity)
    negating = set(lexicon.negations)
    text_polarity = plain_scorer()

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            scores = [text_polarity(value, polarity, intensity, negating) for value in batch]
            yield pd.Series(scores, dtype="float64")

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")(words)


def plugin_polarity(text: Column, scorer: Callable[[str], float]) -> Column:
    """Any Python scorer, on Arrow batches: a struct of ``polarity`` and ``failed``.

    No text and blank text score 0.0. So does a text on which the scorer fails, and it says so.
    """

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def one(value: str | None) -> tuple[float, bool]:
            if not value or not value.strip():
                return 0.0, False
            try:
                return float(scorer(value)), False
            except Exception:
                return 0.0, True

        for batch in batches:
            yield pd.DataFrame([one(value) for value in batch], columns=["polarity", "failed"])

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(score, "polarity double, failed boolean")(text)


def with_sentiment(
    df: DataFrame,
    text: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    form: str = "native",
) -> DataFrame:
    """Add ``polarity`` and ``category`` row by row: no shuffle, batch or stream.

    ``form`` is "native" (expressions, at any size of the lexicon) or "arrow" (the same rule on Arrow
    batches); both give the same double. ``scorer`` plugs in another scorer instead of the lexicon, and
    adds ``scorer_failed``, so that failures are counted and not taken for neutral texts.
    """
    if scorer is not None:
        kept = df.columns
        scored = df.withColumn("_scored", plugin_polarity(F.col(text), scorer)).select(
            *kept, F.col("_scored.polarity").alias("polarity"), F.col("_scored.failed").alias("scorer_failed")
        )
        return scored.withColumn("category", category(F.col("polarity")))
    lexicon = lexicon or Lexicon.starter()
    if form == "arrow":
        scored = df.withColumn("polarity", arrow_polarity(letter_words(F.col(text)), lexicon))
        return scored.withColumn("category", category(F.col("polarity")))
    if form != "native":
        raise ValueError(f"unknown form {form!r}")
    kept = df.columns
    scored = (
        df.withColumn("_words", letter_words(F.col(text)))
        .withColumn("_hits", native_hits(F.col("_words"), lexicon))
        .select(
            *kept,
            F.coalesce(
                mean_polarity(
                    F.aggregate("_hits", F.lit(0).cast("bigint"), lambda total, unit: total + unit),
                    F.size("_hits"),
                ),
                F.lit(0.0),
            ).alias("polarity"),
        )
    )
    return scored.withColumn("category", category(F.col("polarity")))
