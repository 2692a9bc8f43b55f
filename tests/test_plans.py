"""The physical plans are the ones that hold at scale."""

import re

import pytest

from plaudit.catalog.queries import QUERIES
from plaudit.functions import presets
from plaudit.functions.sentiment import with_sentiment
from plaudit.operators import sampling, scoring, windows, words
from plaudit.catalog import corpus

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def raw(spark):
    """Documents as a large table would be read: without spreading."""
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def exchanges(plan):
    return len(re.findall(r"Exchange (?:hash|range|round|single)", plan, re.IGNORECASE))


def test_top_words_reads_one_column_and_shuffles_counts_only(raw):
    plan = plan_of(words.top_words(words.word_frequency(words.word_rows(raw, "text"))))
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<text:string>" in plan
    assert "partial_count" in plan and exchanges(plan) == 1 and "INSET" in plan


def test_sweep_has_one_scan_and_one_shuffle(raw):
    plan = plan_of(sampling.sweep_word_frequency(raw, "doc_id", "text"))
    assert plan.count("FileScan") == 1 and exchanges(plan) == 1 and "partial_count" in plan


def test_range_join_meets_counts_not_texts(raw, spark):
    fractions = spark.createDataFrame([(p,) for p in presets.FRACTIONS], "pct int")
    swept = sampling.sweep_by_range_join(raw, "doc_id", "text", fractions)
    plan = plan_of(swept)
    join = plan.index("BroadcastNestedLoopJoin")
    assert "Generate explode" in plan[join:] and "partial_count" in plan[join:]
    # Counts by (size, word) meet the sizes, not counts by (place, word).
    assert re.search(r"keys=\[_level#\d+L?, word#\d+\], functions=\[partial_count", plan)


def test_join_scorer_moves_known_words_only(raw, spark):
    plan = plan_of(scoring.score_by_join(raw, "doc_id", "text", scoring.lexicon_frame(spark, corpus.LEXICON)))
    assert plan.count("BroadcastHashJoin") >= 3 and "partial_sum" in plan
    assert re.search(r"BroadcastHashJoin \[w#\d+\], \[w#\d+\], Inner", plan)


def test_large_lexicon_is_not_broadcast(raw, spark, no_auto_broadcast):
    table = scoring.lexicon_frame(spark, corpus.LEXICON)
    plan = plan_of(scoring.score_by_join(raw, "doc_id", "text", table, max_broadcast_rows=3))
    assert "Broadcast" not in plan and "hashpartitioning(w" in plan and "_salt" in plan


def test_first_rows_sorts_keys_and_filters_the_scan(raw):
    plan = plan_of(sampling.first_rows(raw, "doc_id", 50))
    assert "LessThanOrEqual(doc_id" in plan and "TakeOrderedAndProject" not in plan


def moved_records(spark, work):
    """What ``work`` gives, and the most records that a stage of its jobs wrote to a shuffle or a task read from one."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def stages():
        listed = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {listed.apply(i).stageId(): listed.apply(i).shuffleWriteRecords() for i in range(listed.size())}

    before = stages()
    found = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return found, max([n for stage, n in stages().items() if stage not in before], default=0)


@pytest.mark.parametrize("last_keys", [100, sampling.LAST_KEYS])
def test_counts_of_keys_move_to_find_the_nth(spark, monkeypatch, last_keys):
    monkeypatch.setattr(sampling, "LAST_KEYS", last_keys)
    places = [0, 1, 20_000, 198_000, 199_999, 200_000, 10**9]
    found, moved = moved_records(spark, lambda: sampling.nth_keys(spark.range(0, 200_000, 1, 8), "id", places))
    assert found == {0: None, 1: 0, 20_000: 19_999, 198_000: 197_999, 199_999: 199_998, 200_000: None, 10**9: None}
    # Eight tasks write counts of some hundred buckets, and no keys.
    assert 0 < moved <= 8 * 2 * (2 * sampling.BOUNDS + 20)


def test_the_nth_of_repeated_and_null_keys_and_texts(spark, monkeypatch):
    monkeypatch.setattr(sampling, "LAST_KEYS", 10)
    rows = [(None,)] * 50 + [("k",)] * 3000 + [(f"k{i:04d}",) for i in range(2000)] + [("",), ("é",)]
    keys = sorted(row[0] for row in rows if row[0] is not None)
    df = spark.createDataFrame(rows, "key string").repartition(5)
    places = [1, 2, 1500, 3001, 3002, 4000, 5001]
    assert sampling.nth_keys(df, "key", places) == {n: keys[n - 1] for n in places}
    assert sampling.first_rows(df, "key", 3002).count() == 3002 and sampling.first_rows(df, "key", 10).count() == 3001
    assert sampling.first_rows(df, "key", 10**6).count() == 5002 and sampling.first_rows(df, "key", 0).count() == 0



def test_hash_sample_runs_before_the_words(raw):
    plan = plan_of(words.word_rows(sampling.hash_sample(raw, "doc_id", 20), "text"))
    assert plan.index("Generate") < plan.index("md5")


def test_top_per_window_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([], "send_ts timestamp, word string, category string")
    counts = windows.flat_windows(windows.sliding_word_counts(df))
    plan = plan_of(windows.top_per_window(counts.repartition(4, "word")))
    assert "WindowGroupLimit" in plan and ", Partial" in plan


@pytest.mark.parametrize("name", ["sentiment_scores", "sentiment_counts", "run_metrics", "profile", "fraction_metrics"])
def test_no_python_in_the_hot_path(spark, name):
    assert "Python" not in plan_of(QUERIES[name](spark, SF))


def test_scorer_cuts_each_text_once(raw):
    assert plan_of(with_sentiment(raw, "text", corpus.LEXICON)).count("regexp_extract_all") == 1


def test_profile_scans_once(spark):
    plan = plan_of(QUERIES["profile"](spark, SF))
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan


def test_no_cartesian_products(spark):
    for name in ("word_frequency", "sentiment_scores_join", "window_top_words", "run_compare"):
        assert "CartesianProduct" not in plan_of(QUERIES[name](spark, SF))
