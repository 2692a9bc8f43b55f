import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plaudit import sizing
from plaudit.operators import metrics, windows


def brute_force(rows, window, slide):
    counts = defaultdict(Counter)
    for second, word, category in rows:
        start = second - second % slide
        while start > second - window:
            counts[start, word]["total"] += 1
            counts[start, word][category] += 1
            start -= slide
    return {
        (start, start + window, word, c["total"], c["positive"], c["negative"], c["neutral"])
        for (start, word), c in counts.items()
    }


def random_words(n=600, span=2400):
    rng = random.Random(1)
    return [
        (rng.randrange(span), rng.choice("abcdefgh"), rng.choice(["positive", "negative", "neutral"]))
        for _ in range(n)
    ]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "s bigint, word string, category string")
    return df.select(F.timestamp_seconds("s").alias("send_ts"), "word", "category")


def flat(df):
    return df.withColumns({name: F.unix_seconds(name) for name in ("window_start", "window_end")})


@pytest.mark.parametrize("window, slide", [(300, 60), (60, 60), (300, 120)])
def test_sliding_counts(spark, window, slide):
    rows = random_words()
    counts = windows.flat_windows(windows.sliding_word_counts(frame(spark, rows), "send_ts", window, slide))
    assert {tuple(r) for r in flat(counts).collect()} == brute_force(rows, window, slide)


def test_top_per_window_and_documents(spark):
    rows = random_words()
    expected = defaultdict(list)
    for start, end, word, *numbers in brute_force(rows, 300, 60):
        expected[start].append((-numbers[0], word, tuple(numbers)))
    counts = windows.flat_windows(windows.sliding_word_counts(frame(spark, rows)))
    top = windows.top_per_window(counts, 3)
    found = defaultdict(list)
    for r in flat(top).orderBy("window_start", "rank").collect():
        found[r.window_start].append((-r.total, r.word, (r.total, r.positive, r.negative, r.neutral)))
    assert found == {start: sorted(entries)[:3] for start, entries in expected.items()}
    back = windows.read_window_documents(windows.window_documents(top)).select(*top.columns)
    assert back.exceptAll(top).count() == 0 and top.exceptAll(back).count() == 0


def test_top_per_window_ties(spark):
    words = [(10, w, "neutral") for w in "gfedcba"]
    top = windows.top_per_window(windows.flat_windows(windows.sliding_word_counts(frame(spark, words), slide_seconds=300)))
    assert [r.word for r in top.orderBy("rank").collect()] == list("abcde")


def test_run_comparison_with_a_zero_time(spark):
    log = spark.createDataFrame(
        [("r", "sequential", "words", 3.0), ("r", "parallel", "words", 1.5),
         ("r", "sequential", "report", 0.25), ("r", "parallel", "report", 0.0),
         ("r", "sequential", "alone", 1.0), ("r", "other", "words", 9.0)],
        "run_id string, mode string, task string, seconds double",
    )
    result = {r.task: r for r in metrics.run_comparison(log, "task", "mode", "seconds", "sequential", "parallel").collect()}
    assert (result["words"].speedup, result["words"].base_label, result["words"].other_label) == (2.0, "3.000 s", "1.500 s")
    assert result["report"].speedup == 1.0
    assert result["alone"].other_seconds is None and result["alone"].speedup is None


def test_rates(spark):
    df = spark.createDataFrame([(100, 4.0), (0, 0.0)], "total_records bigint, total_seconds double")
    rates = [(r.records_per_second, r.ms_per_record) for r in metrics.with_rates(df).orderBy("total_records").collect()]
    assert rates == [(0.0, 0.0), (25.0, 40.0)]


def test_partitions(spark):
    df = spark.range(1000).repartition(7)
    assert metrics.partition_count(df).first()[0] == 7
    assert metrics.partition_report(df).agg(F.sum("rows")).first()[0] == 1000


def test_the_parts_that_count_words_grow_with_the_input_and_not_in_size(spark):
    rows = spark.range(100).select(F.timestamp_seconds("id").alias("send_ts"), F.col("id").cast("string").alias("word"), F.lit("neutral").alias("category"))
    counts = windows.sliding_word_counts(rows)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    # One shuffle for the slides and one by word; none for the copies of the counts.
    assert plan.count("Exchange hashpartitioning") == 2 and "hashpartitioning(word" in plan
    assert sizing.parts_of(rows, 100) > sizing.parts_of(rows, 1000) >= 1
    assert sizing.dealt(rows, "word", part_bytes=10).rdd.getNumPartitions() == sizing.parts_of(rows, 10)
