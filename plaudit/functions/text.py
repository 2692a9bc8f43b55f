"""Column expressions over review text. Batch and stream share them."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Fixed patterns: what separates words, per kind of tokeniser. Python's idea of white space
# is Unicode's plus four ASCII separators. The letters a-z stand first only because they
# are tested fastest.
ASCII_SPACES = " \t\n\x0b\f\r"
ASCII_SPACE = r"[ \t\n\x0B\f\r]"
UNICODE_SPACE = r"(?U)[\s\x1C-\x1F]+"
LETTER_WORD = r"[a-z\p{L}]+(?:'[a-z\p{L}]+)*"


def has_content(text: Column) -> Column:
    """Not null and more than white space."""
    return text.isNotNull() & text.rlike(r"\S")


def cleaned(text: Column) -> Column:
    return F.lower(text)


def batch_tokens(text: Column) -> Column:
    """Lower-case and cut at each ASCII white-space character.

    Two separators in a row give an empty token; callers drop those.
    """
    return F.split(F.lower(text), ASCII_SPACE)


def batch_tokens_with_empty(text: Column) -> Column:
    """As :func:`batch_tokens`, keeping exactly the empty tokens that Spark ML's Tokenizer keeps.

    Leading and inner empty tokens stay, trailing ones go, and text of white
    space alone has no token, while the empty string has one.
    """
    lowered = F.lower(text)
    body = F.rtrim(lowered, F.lit(ASCII_SPACES))
    return F.when((body == "") & (lowered != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, ASCII_SPACE)
    )


def stream_tokens(text: Column) -> Column:
    """Lower-case and cut at runs of Unicode white space; no empty tokens."""
    return F.filter(F.split(F.lower(text), UNICODE_SPACE), lambda word: word != "")


def letter_words(text: Column) -> Column:
    """Lower-case words of letters, with inner apostrophes kept ("don't")."""
    return F.regexp_extract_all(F.lower(text), F.lit(LETTER_WORD), F.lit(0))


def strip_punctuation(word: Column) -> Column:
    return F.regexp_replace(word, r"^\p{Punct}+|\p{Punct}+$", "")


def matches_keyword(text: Column, keywords: Iterable[str], whole_word: bool = False) -> Column:
    """Whether the text holds one of the keywords, in any case.

    By default a keyword also matches inside a longer word ("bad" in "badge").
    """
    words = [keyword.lower() for keyword in keywords]
    if not words:
        return F.lit(False)
    lowered = F.lower(text)
    if not whole_word:
        return reduce(or_, [F.contains(lowered, F.lit(word)) for word in words])
    return lowered.rlike(r"(?<!\p{L})(?:" + "|".join(re.escape(word) for word in words) + r")(?!\p{L})")


def counted_label(name: Column, count: Column) -> Column:
    """A label such as "positive (12)"."""
    return F.concat(name, F.lit(" ("), count.cast("string"), F.lit(")"))


def seconds_label(seconds: Column) -> Column:
    return F.when(seconds.isNotNull(), F.format_string("%.3f s", seconds))


def event_time(epoch_seconds: Column) -> Column:
    """Epoch seconds as a float to a timestamp, exact to the microsecond."""
    return F.timestamp_micros(F.round(epoch_seconds * F.lit(1e6)).cast("bigint"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)
