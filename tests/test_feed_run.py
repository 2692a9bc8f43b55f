"""The stream that writes all its results from one reading: what it gives, and what it gives after failures."""

import random
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plaudit.functions.sentiment import Lexicon, with_sentiment
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.operators.scoring import lexicon_frame, occurring_words, with_table_sentiment
from plaudit.operators.windows import MEASURES, read_window_documents, top_of_parts, top_per_window
from plaudit.sizing import dealt
from plaudit.streaming import feed, run
from plaudit.streaming.run import FeedRun
from test_streaming import BAD, BASE, LEXICON, REVIEWS, Feed, batch_windows, split

SINKS = ["set_aside", "scored", "_ids", "_minutes", "top_words", "_batches"]


@pytest.fixture
def files(tmp_path):
    return Feed(tmp_path / "feed")


def go(spark, files, feed_run, checkpoint, max_files=1):
    query = feed_run.start(feed.read_feed(spark, str(files.folder), max_files), str(checkpoint))
    query.awaitTermination()
    return query


def windows_of(spark, folder):
    return sorted(
        (int(r.window_start.timestamp() - BASE), r["rank"], r.word, r.total, r.positive, r.negative, r.neutral)
        for r in read_window_documents(run.read_windows(spark, str(folder))).collect()
    )


def scored_of(spark, folder):
    return sorted((int(r.review_id), r.category) for r in run.read_scored(spark, str(folder)).collect())


SCORED = [(1, "positive"), (2, "negative"), (3, "neutral"), (5, "positive"), (6, "neutral"), (7, "neutral"), (8, "positive"), (9, "positive")]


def test_all_results_from_one_reading(spark, files, tmp_path):
    for part in split(REVIEWS, 2):
        files.reviews(*part)
    files.add(*BAD)
    query = go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON, delay_seconds=60), tmp_path / "c")
    assert windows_of(spark, tmp_path / "out") == batch_windows(spark, REVIEWS, 2000 - 60)
    assert scored_of(spark, tmp_path / "out") == SCORED
    assert {r.value: r.problem for r in run.read_set_aside(spark, str(tmp_path / "out")).collect()} == BAD
    # Every record is read once, though three sinks and the counts take it.
    assert sum(p.numInputRows for p in query.recentProgress) == len(REVIEWS) + len(BAD)
    totals = run.batches(spark, str(tmp_path / "out")).agg(F.sum("records").alias("n"), F.sum("kept").alias("kept"), F.sum("set_aside").alias("bad"), F.max("watermark_us").alias("mark")).first()
    # Records without a keyword are in no sink.
    assert (totals.n, totals.kept, totals.bad) == (len(SCORED) + len(BAD), len(SCORED), len(BAD))
    assert totals.mark == (BASE + 2000 - 60) * 1e6


@pytest.mark.parametrize("sink, failing_batch", list(zip(SINKS, (0, 1, 1, 0, 1, 1))))
def test_a_crash_in_a_sink_loses_and_repeats_nothing(spark, files, tmp_path, sink, failing_batch):
    for part in split(REVIEWS + REVIEWS[:3], 6):
        files.reviews(*part)
    files.add(*BAD)
    failed = []

    def fail(name, number):
        if name == sink and number == failing_batch and not failed:
            failed.append(number)
            if name != "_batches":
                # Part of the sink's files are there, the others are not.
                (folder,) = (tmp_path / "out" / sink).glob(f"run=*/batch={number}")
                for part in sorted(folder.glob("part-*"))[1:] or folder.glob("part-*"):
                    part.unlink()
            raise RuntimeError("stopped")

    feed_run = FeedRun(str(tmp_path / "out"), LEXICON, delay_seconds=2000, drop_repeats=True, after=fail)
    with pytest.raises(StreamingQueryException):
        go(spark, files, feed_run, tmp_path / "c")
    before = run.batches(spark, str(tmp_path / "out")).count()
    assert before == failing_batch + (sink == "_batches")
    seen = scored_of(spark, tmp_path / "out")
    assert len(seen) == len(set(seen))  # only whole batches are read
    go(spark, files, feed_run, tmp_path / "c")
    assert scored_of(spark, tmp_path / "out") == SCORED
    assert len(run.read_set_aside(spark, str(tmp_path / "out")).collect()) == len(BAD)
    assert windows_of(spark, tmp_path / "out") == batch_windows(spark, REVIEWS, 2000 - 2000)
    repeats = run.batches(spark, str(tmp_path / "out")).agg(F.sum("repeats")).first()[0]
    assert repeats == 3


def test_two_checkpoints_share_a_folder(spark, files, tmp_path):
    for part in split(REVIEWS, 4):
        files.reviews(*part)
    for checkpoint in ("one", "two"):
        go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON, delay_seconds=60), tmp_path / checkpoint)
    assert scored_of(spark, tmp_path / "out") == sorted(SCORED * 2)
    assert windows_of(spark, tmp_path / "out") == sorted(batch_windows(spark, REVIEWS, 2000 - 60) * 2)


def test_late_records_are_kept_but_not_counted_twice(spark, files, tmp_path):
    files.reviews((1, "great one", 0), (2, "great two", 400))
    files.reviews((3, "great early", 350))  # within the delay
    files.reviews((4, "great late", 10))  # its last window ended at 300, the watermark is at 340
    files.reviews((5, "great end", 3000))
    go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON, delay_seconds=60), tmp_path / "c")
    rows = [(1, "great one", 0), (2, "great two", 400), (3, "great early", 350), (5, "great end", 3000)]
    assert windows_of(spark, tmp_path / "out") == batch_windows(spark, rows, 3000 - 60)
    assert [i for i, _ in scored_of(spark, tmp_path / "out")] == [1, 2, 3, 4, 5]
    assert run.batches(spark, str(tmp_path / "out")).agg(F.sum("late")).first()[0] == 1


def test_repeats_are_dropped_within_the_delay_across_batches(spark, files, tmp_path):
    files.reviews(*[(1, "great", 0)] * 300, (2, "great", 5))
    files.reviews(*[(1, "great", 90)] * 300, (3, "great", 100))
    files.reviews((2, "great", 500), (4, "great", 500))  # the first 2 is still within the delay of the watermark at 0
    files.reviews((5, "great", 1000))
    files.reviews((1, "great", 1100), (2, "great", 850))  # 1 is forgotten, 2 is too old
    go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON, delay_seconds=100, drop_repeats=True), tmp_path / "c")
    assert [i for i, _ in scored_of(spark, tmp_path / "out")] == [1, 1, 2, 3, 4, 5]
    totals = run.batches(spark, str(tmp_path / "out")).agg(F.sum("repeats").alias("repeats"), F.sum("late").alias("late")).first()
    assert (totals.repeats, totals.late) == (299 + 300 + 1, 1)


def test_a_failing_sink_fails_the_stream(spark, files, tmp_path):
    files.reviews(*REVIEWS)
    (tmp_path / "blocked").write_text("a file where the folder should be")
    with pytest.raises(StreamingQueryException):
        go(spark, files, FeedRun(str(tmp_path / "blocked"), LEXICON), tmp_path / "c")


def test_a_folder_without_the_checkpoint_s_batches_is_an_error(spark, files, tmp_path):
    files.reviews(*REVIEWS)
    go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON), tmp_path / "c")
    shutil.move(tmp_path / "out", tmp_path / "elsewhere")
    files.reviews((10, "great", 3000))
    with pytest.raises(StreamingQueryException, match="no record of batch 0"):
        go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON), tmp_path / "c")


def test_windows_are_made_of_whole_slides():
    with pytest.raises(ValueError):
        FeedRun("out", window_seconds=300, slide_seconds=70)


FULL = Lexicon({"good": 0.7, "bad": -0.7, "great": 0.8}, {"very": 1.3}, ("not",))
TEXTS = ["good", "not good", "very bad day", "", None, " \t", "nothing", "great not very good", "12 34"] * 3


@pytest.mark.parametrize("max_words", [1, 1000])
def test_a_lexicon_as_a_table_of_any_size(spark, max_words, no_auto_broadcast):
    df = spark.createDataFrame(list(enumerate(TEXTS)), f"id bigint, {CLEAN_TEXT} string").repartition(3)
    table = lexicon_frame(spark, FULL).unionByName(
        spark.range(30_000).selectExpr("concat('filler', id) word", "0.5D polarity", "cast(null as double) intensity", "false negates")
    )
    expected = {r.id: (r.polarity, r.category) for r in with_sentiment(df, CLEAN_TEXT, FULL).collect()}
    scored = with_table_sentiment(df, CLEAN_TEXT, table, max_words)
    assert scored.columns == ["id", CLEAN_TEXT, "polarity", "category"]
    assert {r.id: (r.polarity, r.category) for r in scored.collect()} == expected and scored.count() == len(TEXTS)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (max_words == 1)  # texts stay in place if the words that occur are few


def test_chunks_of_texts_get_the_words_that_occur_in_them(spark, no_auto_broadcast):
    rows = [(i % 20, text, [i], {"k": i}) for i, text in enumerate(TEXTS)] + [(0, "not good", [0], {"k": 0})] * 40 + [(None, "bad", None, None)]
    rows += [(100 + i, " ".join(f"filler{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}" for j in range(676)), [], {}) for i in range(40)]
    df = spark.createDataFrame(rows, f"id bigint, {CLEAN_TEXT} string, list array<int>, pairs map<string, int>").repartition(3)
    letters = F.concat(F.lit("filler"), *[F.char((F.col("id") / 26**k).cast("bigint") % 26 + 97) for k in range(3)])
    filler = spark.range(26**3).select(letters.alias("word"), F.lit(0.5).alias("polarity"), F.lit(None).cast("double").alias("intensity"), F.lit(False).alias("negates"))
    table = lexicon_frame(spark, FULL).unionByName(filler)
    full = Lexicon({**FULL.polarity, **{row.word: 0.5 for row in filler.collect()}}, FULL.intensity, FULL.negations)
    expected = with_sentiment(df, CLEAN_TEXT, full, form="arrow")
    scored = with_table_sentiment(df, CLEAN_TEXT, table, max_words=10_000, chunk_bytes=50_000)
    assert scored.columns == expected.columns and sorted(map(str, scored.collect())) == sorted(map(str, expected.collect()))
    # 17,000 words occur: none of them goes through the driver.
    assert "Join" in scored._jdf.queryExecution().executedPlan().toString()


def test_a_stream_takes_a_million_words(spark, files, tmp_path):
    for part in split(REVIEWS, 4):
        files.reviews(*part)
    million = spark.range(1_000_000).selectExpr("concat('filler', id) word", "0.5D polarity", "cast(null as double) intensity", "false negates")
    table = lexicon_frame(spark, LEXICON).unionByName(million)
    go(spark, files, FeedRun(str(tmp_path / "out"), table, delay_seconds=60), tmp_path / "c")
    assert scored_of(spark, tmp_path / "out") == SCORED


def test_copies_are_made_as_they_are_sent(spark, tmp_path):
    df = spark.range(50).select("id", F.lit("great").alias(CLEAN_TEXT), F.timestamp_seconds("id").alias("ts"))
    folder = str(tmp_path / "feed")
    feed.replay(df, "id", CLEAN_TEXT, "ts", folder, 2, lambda: None, copies=3, compression="snappy")
    assert spark.read.parquet(f"{folder}-staged").count() == 50
    sent = feed.decode(spark.read.schema("key string, value string").json(folder)).groupBy("review_id").count().collect()
    assert len(sent) == 50 and {row["count"] for row in sent} == {3}
    assert all(file.name.endswith(".snappy") for file in (tmp_path / "feed").glob("part-*"))


def test_tasks_of_a_batch_are_bounded(spark, files, tmp_path):
    files.reviews(*REVIEWS)
    bounds = run._bounded_tasks(spark)
    assert bounds == {key: f"{most}b" for key, most in run.TASK_BYTES.items()}
    go(spark, files, FeedRun(str(tmp_path / "out"), LEXICON), tmp_path / "c")
    assert scored_of(spark, tmp_path / "out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert list(run._bounded_tasks(spark)) == ["spark.sql.adaptive.advisoryPartitionSizeInBytes"]  # the user's own wins
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_value_is_parsed_once_whatever_the_filter_names(spark):
    df = spark.createDataFrame([("0", value) for value in [*BAD, None, '{"review_id": "1", "cleaned_reviewText": "great", "send_time": 1.5}']], "key string, value string")
    decoded = feed.decode(df).filter(F.col("problem").isNotNull() | F.col(CLEAN_TEXT).contains("great") | F.col(CLEAN_TEXT).contains("bad"))
    assert decoded._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted((r.review_id or "", r.problem or "") for r in decoded.collect()) == sorted([("1", ""), *[(r.review_id or "", r.problem or "") for r in feed.decode(df).collect() if r.problem]])


@pytest.mark.parametrize("after, until", [(None, 100), (100, 420), (None, None), (420, 420)])
def test_the_best_words_of_parts_are_those_of_all(spark, after, until):
    draw = random.Random(5)
    words = ["a", "b", "Z", "\u00e9", "\uffee", "\U0001f600", *[f"w{i}" for i in range(30)]]
    # Gaps between slides, slides before 1970, ties, and counts of a word and slide in several rows.
    rows = [(60 * draw.choice([-9, -2, -1, 0, 1, 2, 3, 4, 9]), word, n, n, 0, 0) for word in words for n in draw.choices(range(1, 4), k=9)]
    counts = spark.createDataFrame([*rows, (None, "a", 9, 9, 0, 0)], "slide bigint, word string, " + ", ".join(f"{name} bigint" for name in MEASURES))
    after_us, until_us = (None if mark is None else mark * 1_000_000 for mark in (after, until))
    totals = {}
    for slide, word, n, *_ in rows:
        for start in range(slide - 240, slide + 1, 60):
            if (after is None or start + 300 > after) and (until is None or start + 300 <= until):
                totals.setdefault(start, {}).setdefault(word, []).append(n)
    expected = {
        (start, rank, word, sum(found[word]), sum(found[word]), 0)
        for start, found in totals.items()
        for rank, word in enumerate(sorted(found, key=lambda w: (-sum(found[w]), w.encode()))[:5], 1)
    }
    parts = top_of_parts(dealt(counts, "word"), 5, 300, 60, after_us, until_us)
    best = top_per_window(parts).select(F.unix_seconds("window_start").alias("s"), "rank", "word", "total", "positive", "negative").collect()
    assert {tuple(row) for row in best} == expected and len(best) == len(expected)
    of_part = parts.groupBy(F.spark_partition_id(), "window_start").count().agg(F.max("count")).first()[0]
    assert (of_part or 0) <= 5  # no more leaves a part


def test_words_of_a_lexicon_table_are_not_broadcast(spark):
    df = spark.createDataFrame([("good day",)], "text string")
    found = occurring_words(df, "text", lexicon_frame(spark, FULL))
    assert [r.word for r in found.collect()] == ["good"]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
