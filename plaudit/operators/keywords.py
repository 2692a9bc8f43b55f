"""Rows whose text holds a keyword of a table of any size.

A long list of alternatives would be tried at every place of every text. Here keywords meet the *words that occur*, each
once: a keyword, or the longest word of a phrase, lies within one word of the text, so it is looked for by one of its
letter groups (of ``GRAM`` letters, or its whole if shorter) among those of the distinct words, and verified there. What is left are the words that hold
a keyword, with the phrases that may begin there; the texts are tested for those, and stay in place.

A phrase of three words or more has words with white space on both sides, which are whole words of any text that holds it. It is looked for by
them (its *core*) and never by a part of a word: a short part lies in a large share of all words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions.text import ASCII_SPACES
from plaudit.sizing import is_small, lookup_join

GRAM = 5
#: Words of a core.
CORE = 2
#: Words and phrases that travel with the tasks, and so pass the driver.
IN_MEMORY_WORDS = 50_000
#: What separates words here (fixed pattern).
SPACES = r"[ \t\n\x0B\f\r]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def _grams(word: Column, size: int) -> Column:
    """Hashes of all groups of ``size`` letters of a word, in linear time."""
    letters = F.split(word, "")
    places = F.sequence(F.lit(1), F.size(letters) - (size - 1))
    return F.when(F.size(letters) >= size, F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(letters, i, F.lit(size)), "")))).otherwise(
        F.array().cast("array<bigint>")
    )


def _lowered(keywords: DataFrame) -> DataFrame:
    return keywords.select(F.lower("keyword").alias("keyword")).filter(F.col("keyword") != "").distinct()


def core_phrases(keywords: DataFrame) -> DataFrame:
    """(core, phrase) of the phrases of three words or more: the first ``CORE`` of the words between the outer two."""
    words = _words(F.col("keyword"))
    core = F.array_join(F.slice(words, F.lit(2), F.least(F.lit(CORE), F.size(words) - 2)), " ")
    return _lowered(keywords).filter(F.size(words) >= 3).select(core.alias("core"), F.col("keyword").alias("phrase"))


def _runs(words: Column) -> Column:
    """All runs of one to ``CORE`` words, spelled as cores are."""
    def run(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
        return F.when(F.size(words) >= size, F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(size)), " "))).otherwise(
            F.array().cast("array<string>")
        )

    return F.array_distinct(F.concat(*[run(size) for size in range(1, CORE + 1)]))


def prepared(keywords: DataFrame) -> DataFrame:
    """(keyword, piece, gram): each keyword once, lower-cased, with the word and the letter group that it is looked for by.

    Null keywords and those without a word are left out, and so are phrases with a core (:func:`core_phrases`).
    """
    lowered = _lowered(keywords).filter(F.size(_words(F.col("keyword"))) < 3)
    longest = F.array_max(F.transform(_words(F.col("keyword")), lambda word: F.struct(F.length(word).alias("n"), word.alias("word"))))
    pieces = lowered.select("keyword", longest["word"].alias("piece")).filter("piece is not null")
    short = F.when(F.length("piece") < GRAM, F.xxhash64("piece"))
    return pieces.withColumn("gram", F.coalesce(short, F.array_min(_grams(F.col("piece"), GRAM))))


def keyword_words(df: DataFrame, text: str, keywords: DataFrame) -> DataFrame:
    """(word, phrase): the words of the texts that hold a keyword; with the phrase to be verified, or null for a keyword of one word."""
    table = prepared(keywords)
    sizes = [row[0] for row in table.select(F.least(F.length("piece"), F.lit(GRAM))).distinct().collect()]  # at most GRAM
    words = df.select(F.explode(F.array_distinct(_words(F.lower(F.col(text))))).alias("word")).distinct()
    if not sizes:
        return words.filter(F.lit(False)).select("word", F.lit(None).cast("string").alias("phrase"))
    grams = F.array_distinct(F.concat(*[_grams(F.col("word"), size) for size in sizes]))
    met = lookup_join(words.select("word", F.explode(grams).alias("gram")), table, "gram", "word", is_small(table), "inner")
    phrase = F.when(F.col("piece") != F.col("keyword"), F.col("keyword"))
    # Of two words, the first ends a word of the text and the second begins one.
    parts = _words(F.col("keyword"))
    ends = (F.get(parts, 0) == F.col("piece")) & F.endswith("word", "piece")
    begins = (F.get(parts, 1) == F.col("piece")) & F.startswith("word", "piece")
    return met.filter(F.contains("word", "piece") & ((F.size(parts) == 1) | ends | begins)).select("word", phrase.alias("phrase")).distinct()


def holds_one_of(text: Column, words: dict[str, list[str]], cores: dict[str, list[str]] | None = None) -> Column:
    """Whether a lower-cased text has one of the words, and if that lists phrases, one of them; or one of the phrases of a core."""
    cores = cores or {}
    sizes = sorted({core.count(" ") + 1 for core in cores})
    cut = re.compile(f"[{re.escape(ASCII_SPACES)}]+")

    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(value: str | None) -> bool:
            if value is None:
                return False
            parts = cut.split(value)
            for word in set(parts) & words.keys():
                if not words[word] or any(phrase in value for phrase in words[word]):
                    return True
            for size in sizes:
                runs = parts if size == 1 else map(" ".join, zip(*[parts[i:] for i in range(size)]))
                if any(phrase in value for core in cores.keys() & set(runs) for phrase in cores[core]):
                    return True
            return False

        for batch in batches:
            yield pd.Series([one(value) for value in batch], dtype="bool")

    test.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(test, "boolean")(text)


def keyword_table_filter(df: DataFrame, text: str, keywords: DataFrame, max_words: int = IN_MEMORY_WORDS) -> DataFrame:
    """Rows whose text holds, in any case, one of the keywords of a table (keyword).

    If at most ``max_words`` words (with phrases) and as many phrases with a core are left, they travel with the tasks and texts stay where they are.
    Otherwise the texts' words and runs of words meet them in joins, by a hash of the text.
    """
    found, phrased = keyword_words(df, text, keywords), core_phrases(keywords)
    rows, cored = found.limit(max_words + 1).collect(), phrased.limit(max_words + 1).collect()
    if max(len(rows), len(cored)) <= max_words:
        words: dict[str, list[str]] = defaultdict(list)
        for row in rows:
            if row.phrase is not None:
                words[row.word].append(row.phrase)
        words |= {row.word: [] for row in rows if row.phrase is None}  # which hold a keyword by themselves
        cores: dict[str, list[str]] = defaultdict(list)
        for row in cored:
            cores[row.core].append(row.phrase)
        return df.filter(holds_one_of(F.lower(F.col(text)), dict(words), dict(cores)))
    lowered = F.lower(F.col(text))
    # Half of the hash is enough to tell texts apart; texts without a value have no key and no match.
    keyed = df.withColumn("_key", F.unhex(F.substring(F.sha2(lowered, 256), 1, 32)))
    occurring = keyed.select("_key", F.explode(F.array_distinct(_words(lowered))).alias("word"))
    met = lookup_join(occurring, found, "word", "_key", is_small(found), "inner")
    runs = keyed.select("_key", F.explode(_runs(_words(lowered))).alias("core"))
    cored = lookup_join(runs, phrased, "core", "_key", is_small(phrased), "inner")
    sure = met.filter("phrase is null").select("_key").distinct()
    phrases = met.filter("phrase is not null").select("_key", "phrase").union(cored.select("_key", "phrase")).distinct()
    verified = keyed.select("_key", lowered.alias("_text")).join(phrases, "_key").filter(F.contains("_text", "phrase"))
    hits = sure.union(verified.select("_key")).distinct()
    return keyed.join(hits, "_key", "left_semi").select(*df.columns)
