import pyarrow as pa
import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from plaudit.functions import presets
from plaudit.functions.text import (
    batch_tokens,
    batch_tokens_with_empty,
    epoch_seconds,
    event_time,
    has_content,
    letter_words,
    matches_keyword,
    seconds_label,
    stream_tokens,
    strip_punctuation,
)

EDGES = ["", " a", "x  y", "b ", "A B", "t\tu\nv", "   ", "It's\x0bOK", "É é", " \t\n"]


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string")


def column(df, expr):
    return [r[0] for r in df.orderBy("id").select(expr).collect()]


def test_tokens_equal_spark_ml(spark):
    df = rows(spark, EDGES)
    ml = [r.w for r in Tokenizer(inputCol="t", outputCol="w").transform(df).orderBy("id").collect()]
    assert column(df, batch_tokens_with_empty(F.col("t"))) == ml
    ours = column(df, batch_tokens(F.col("t")))
    assert [[w for w in words if w] for words in ours] == [[w for w in words if w] for words in ml]


def test_stop_words_equal_spark_ml(spark):
    assert list(presets.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(presets.ENGLISH_STOP_WORDS) == 181


def test_null_text_has_no_tokens(spark):
    df = rows(spark, [None])
    assert column(df, batch_tokens(F.col("t"))) == [None]
    assert df.select(F.explode(batch_tokens(F.col("t")))).count() == 0


def test_stream_tokens_split_like_python(spark):
    texts = EDGES + ["a\x1cb\x85c d　e f", "​ x"]
    assert column(rows(spark, texts), stream_tokens(F.col("t"))) == [t.lower().split() for t in texts]


def test_stream_tokens_split_at_every_code_point_like_python(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(pa.table({"id": codes, "t": [f"a{chr(c)}b" for c in codes]}))
    cut = {r.id for r in df.filter(F.size(stream_tokens(F.col("t"))) > 1).select("id").collect()}
    assert cut == {c for c in codes if chr(c).isspace()}


def test_has_content(spark):
    df = rows(spark, ["a", "", "  ", "\t\n", None])
    assert [bool(x) for x in column(df, has_content(F.col("t")))] == [True, False, False, False, False]


def test_letter_words(spark):
    df = rows(spark, ["Don't stop, it's 5x 'good'!", "", "Über-cool", "a²b"])
    assert column(df, letter_words(F.col("t"))) == [
        ["don't", "stop", "it's", "x", "good"], [], ["über", "cool"], ["a", "b"],
    ]


def test_strip_punctuation(spark):
    df = rows(spark, ["the.", "(of,", "don't", "...", "a-b"])
    assert column(df, strip_punctuation(F.col("t"))) == ["the", "of", "don't", "", "a-b"]


@pytest.mark.parametrize(
    "whole, expected", [(False, [True, True, False, True, False]), (True, [False, True, False, True, False])]
)
def test_keywords(spark, whole, expected):
    df = rows(spark, ["a badge", "GREAT", "good", "so bad.", ""])
    assert column(df, matches_keyword(F.col("t"), presets.STREAM_KEYWORDS, whole)) == expected


def test_keywords_are_literal(spark):
    df = rows(spark, ["a+b", "aab", "x.y", "xzy"])
    for whole in (False, True):
        assert column(df, matches_keyword(F.col("t"), ["a+b", "x.y"], whole)) == [True, False, True, False]
    assert column(df, matches_keyword(F.col("t"), [])) == [False] * 4


def test_event_time_is_exact(spark):
    micros = [0, 1, 1704067207179575, 1706657832999999, 1706657832000001]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(micros)], "id int, m bigint")
    back = F.unix_micros(event_time(epoch_seconds(F.timestamp_micros("m"))))
    assert column(df, back) == micros


def test_seconds_label(spark):
    df = spark.createDataFrame([(0, 1.5), (1, None)], "id int, s double")
    assert column(df, seconds_label(F.col("s"))) == ["1.500 s", None]
