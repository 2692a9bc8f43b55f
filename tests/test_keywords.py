import random

import pytest
from pyspark.sql import functions as F

from plaudit.operators import keywords

TEXTS = ["A badge", "bad\tday", "", None, "  ", "good", "very good phone", "very\ngood phone", "x" * 5000 + "needle", "ÜBER maß", "ab", "so so"]


def expected(texts, words):
    return [i for i, text in enumerate(texts) if text is not None and any(word.lower() in text.lower() for word in words)]


def found(spark, texts, words, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").withColumn("keyword", F.lit(1)).repartition(3)
    table = spark.createDataFrame([(word,) for word in words], "keyword string")
    rows = keywords.keyword_table_filter(df, "text", table, **options)
    assert rows.columns == ["id", "text", "keyword"]
    return sorted(row.id for row in rows.collect())


@pytest.mark.parametrize("max_words", [0, 1000])
@pytest.mark.parametrize("words", [
    ["bad"], ["Good Phone", "zzz"], ["needle", "b"], ["über", "MAß"], [""], [], ["o s", "good phone very"], [None, "badge", "badge"],
])
def test_keywords_of_a_table(spark, words, max_words):
    given = [word for word in words if word]
    assert found(spark, TEXTS, words, max_words=max_words) == expected(TEXTS, given)


def test_a_hundred_thousand_keywords(spark):
    rng = random.Random(2)
    letters = "abcdefgh"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 9))) for _ in range(100_000)]
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 10))) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    hits = found(spark, texts, words)
    assert hits == expected(texts, words) and 5 < len(hits) < 145


def test_white_space_is_no_keyword(spark):
    assert found(spark, TEXTS, ["  ", "\t", "", None]) == []


def test_texts_are_not_shuffled(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    plan = keywords.keyword_table_filter(df, "text", spark.createDataFrame([("bad",)], "keyword string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("max_words", [0, 1000])
@pytest.mark.parametrize("words", [
    ["y good ph"], ["ery good p", "so"], [" very good phone"], ["very\ngood p"], ["a b c d e"], ["b c d", "x y"], ["good  phone x"], ["c d "], [" b"],
])
def test_phrases_begin_and_end_within_words(spark, words, max_words):
    texts = [*TEXTS, "xa b c d ey", "a  b c d e", "a b", "ab c", "c d", "c d e", "good  phone x", "good phone x", "x\ty", "zx yz", "z xy z"]
    assert found(spark, texts, words, max_words=max_words) == expected(texts, words)


def test_phrases_do_not_multiply_the_words(spark):
    # The longest word of each phrase lies within every word of the texts: they met as 300 x 400 pairs.
    texts = [" ".join(f"w{i}the{j}" for j in range(20)) for i in range(20)] + ["a the b", "x a the b7 c", "the 7"]
    words = [f"a the b{i}" for i in range(299)] + ["e 7"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    table = spark.createDataFrame([(word,) for word in words], "keyword string")
    assert keywords.keyword_words(df, "text", table).count() <= 400
    assert found(spark, texts, words) == expected(texts, words)
