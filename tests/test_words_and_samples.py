from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from plaudit.functions import presets
from plaudit.functions.text import batch_tokens_with_empty
from plaudit.operators import sampling, words
from plaudit.operators.ingest import clean_reviews, exclude_texts, non_blank

SMALL = "/root/testdata/sf0.001/documents.parquet"


def documents(spark):
    return spark.read.parquet(SMALL).select("doc_id", "text")


def as_counter(df):
    return Counter({r.word: r.frequency for r in df.collect()})


def test_word_frequency_equals_spark_ml(spark):
    df = documents(spark)
    ml = StopWordsRemover(inputCol="words", outputCol="kept").transform(
        Tokenizer(inputCol="text", outputCol="words").transform(df)
    )
    expected = ml.select(F.explode("kept").alias("word")).groupBy("word").agg(F.count("*").alias("frequency"))
    with_empty = words.word_frequency(words.word_rows(df, "text", tokens=batch_tokens_with_empty, keep_empty=True))
    assert as_counter(with_empty) == as_counter(expected)
    plain = words.word_frequency(words.word_rows(df, "text"))
    assert as_counter(plain) == as_counter(expected.filter("word <> ''"))


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([("d c b a d c b a e f g h i j k l",)], "t string")
    top = words.top_words(words.word_frequency(words.word_rows(df, "t", stop_words=())), 6).collect()
    assert [(r.word, r.frequency) for r in top] == [("a", 2), ("b", 2), ("c", 2), ("d", 2), ("e", 1), ("f", 1)]


def test_stop_words_by_table(spark):
    df = spark.createDataFrame([("The cat the dog the end",)], "t string")
    rows = words.word_rows(df, "t", stop_words=())
    stop = spark.createDataFrame([("the",), ("the",)], "word string")
    assert as_counter(words.drop_words(rows, stop)) == {"cat": 1, "dog": 1, "end": 1}


def test_clean_blank_and_placeholders(spark):
    df = spark.createDataFrame([("Good",), (None,), ("",), (" \t",), ("N/A",)], "reviewText string")
    clean = clean_reviews(df)
    assert sorted(r[0] for r in clean.collect()) == ["", " \t", "good", "n/a"]
    assert sorted(r[0] for r in exclude_texts(non_blank(clean), "cleaned_reviewText", ["n/a"]).collect()) == ["good"]
    assert exclude_texts(clean, "cleaned_reviewText").count() == 4


def test_samples_are_nested_and_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    before = set()
    for percent in presets.FRACTIONS:
        ids = {r.k for r in sampling.hash_sample(df, "k", percent).collect()}
        again = {r.k for r in sampling.hash_sample(df.repartition(13), "k", percent).collect()}
        assert ids == again and before <= ids
        assert abs(len(ids) / 5000 - percent / 100) < 0.03
        before = ids
    assert len(before) == 5000


def test_bernoulli_sample(spark):
    df = spark.range(20000)
    assert sampling.bernoulli_sample(df, 1.0).count() == 20000
    first, second = (sampling.bernoulli_sample(df, 0.2, seed=3) for _ in range(2))
    assert first.exceptAll(second).count() == 0 and 3500 < first.count() < 4500
    assert first.exceptAll(sampling.bernoulli_sample(df, 0.2, seed=4)).count() > 0


def test_first_rows(spark):
    df = documents(spark)
    assert sorted(r.doc_id for r in sampling.first_rows(df.repartition(5), "doc_id", 17).collect()) == list(range(17))
    assert sampling.first_rows(df, "doc_id", 0).count() == 0
    assert sampling.first_rows(df, "doc_id", 10**6).count() == df.count()
    text = df.select(F.format_string("k%06d", "doc_id").alias("k"))
    assert sorted(r.k for r in sampling.first_rows(text, "k", 3).collect()) == ["k000000", "k000001", "k000002"]


def test_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d"), (None, "e")], "k bigint, text string")
    assert sampling.hash_sample(df, "k", 100).count() == 5
    assert [sorted(r.text for r in sampling.first_rows(df, "k", n).collect()) for n in (2, 3, 9)] == [
        ["a", "b"], ["a", "b", "d"], ["a", "b", "d"],
    ]
    fractions = spark.createDataFrame([(100,)], "pct int")
    for swept in (sampling.sweep_word_frequency(df, "k", "text", [100], stop_words=()),
                  sampling.sweep_by_range_join(df, "k", "text", fractions, stop_words=())):
        assert sorted(r.word for r in swept.collect()) == ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize("size", [120, -1, None])
def test_sizes_outside_the_range_are_errors(spark, size):
    df = spark.createDataFrame([(1, "a")], "k bigint, text string")
    with pytest.raises(Exception, match="whole percent"):
        sampling.sweep_by_range_join(df, "k", "text", spark.createDataFrame([(size,)], "pct int")).collect()
    if size is not None:
        with pytest.raises(ValueError, match="whole percent"):
            sampling.sweep_word_frequency(df, "k", "text", [size])


def test_sweep_equals_single_runs(spark):
    df = documents(spark)
    sweep = sampling.sweep_word_frequency(df, "doc_id", "text").cache()
    fractions = spark.createDataFrame([(p,) for p in presets.FRACTIONS] + [(20,)], "pct int")
    joined = sampling.sweep_by_range_join(df, "doc_id", "text", fractions)
    assert sweep.exceptAll(joined).count() == 0 and joined.exceptAll(sweep).count() == 0
    for percent in presets.FRACTIONS:
        alone = words.word_frequency(words.word_rows(sampling.hash_sample(df, "doc_id", percent), "text"))
        assert as_counter(sweep.filter(F.col("pct") == percent)) == as_counter(alone)
    sweep.unpersist()


def test_ranked_words_are_written_in_their_order(spark, tmp_path):
    rows = [(" ".join(f"w{i % (1 + i // 7)}" for i in range(500)),), ("b a b a c",)]
    df = spark.createDataFrame(rows * 50, "text string").repartition(5)
    frequency = words.word_frequency(words.word_rows(df, "text", stop_words=()))
    words.ranked(frequency).write.parquet(str(tmp_path / "sorted"))
    found = [
        (r.word, r.frequency)
        for file in sorted((tmp_path / "sorted").glob("part-*.parquet"))
        for r in spark.read.parquet(str(file)).collect()
    ]
    assert found == sorted(found, key=lambda row: (-row[1], row[0])) and len(found) == frequency.count()
