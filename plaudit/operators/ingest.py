"""Raw rows to clean rows, and the rows that are set aside."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from plaudit.functions.text import cleaned, has_content, matches_keyword

CLEAN_TEXT = "cleaned_reviewText"


def clean_reviews(df: DataFrame, text: str = "reviewText", keep: Iterable[str] = ()) -> DataFrame:
    """Drop null texts and lower-case the others into ``cleaned_reviewText``."""
    return df.filter(F.col(text).isNotNull()).select(*keep, cleaned(F.col(text)).alias(CLEAN_TEXT))


def non_blank(df: DataFrame, text: str = CLEAN_TEXT) -> DataFrame:
    return df.filter(has_content(F.col(text)))


def exclude_texts(df: DataFrame, text: str, texts: Iterable[str] = ()) -> DataFrame:
    """Drop rows whose text is one of a few given placeholders."""
    texts = list(texts)
    return df.filter(~F.col(text).isin(texts)) if texts else df


def keyword_filter(df: DataFrame, text: str, keywords: Iterable[str], whole_word: bool = False) -> DataFrame:
    return df.filter(matches_keyword(F.col(text), keywords, whole_word))
