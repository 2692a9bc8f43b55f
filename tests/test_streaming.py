import json
import time

import pytest
from pyspark.sql import functions as F

from plaudit.functions.sentiment import Lexicon
from plaudit.functions.text import epoch_seconds, event_time
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.operators.windows import read_window_documents, top_per_window
from plaudit.streaming import feed, top_words as stream

LEXICON = Lexicon({"good": 0.7, "bad": -0.7, "great": 0.8})
BASE = 1_700_000_040.0  # a full minute


class Feed:
    """Record files written one after the other, each younger than the one before."""

    def __init__(self, folder):
        self.folder, self.n = folder, 0
        folder.mkdir()

    def add(self, *values):
        path = self.folder / f"{self.n:03d}.json"
        path.write_text("".join(json.dumps({"key": "0", "value": v}) + "\n" for v in values))
        self.n += 1
        time.sleep(0.02)

    def reviews(self, *rows):
        self.add(*[
            json.dumps({"review_id": i, CLEAN_TEXT: text, "send_time": BASE + at}) for i, text, at in rows
        ])


@pytest.fixture
def files(tmp_path):
    return Feed(tmp_path / "feed")


def records(spark, files, max_files=1):
    good = feed.good_records(feed.decode(feed.read_feed(spark, str(files.folder), max_files)))
    return good.withColumn("review_id", F.col("review_id").cast("bigint"))


def run_windows(spark, files, tmp_path, delay="60 seconds", name="w", per_slide=True):
    scored = stream.scored_records(records(spark, files), LEXICON)
    counts = stream.windowed_words(scored, delay=delay, per_slide=per_slide)
    query = stream.write_top_words(
        counts, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), state_partitions=2
    )
    query.awaitTermination()
    return query


def windows_of(spark, tmp_path, name="w"):
    rows = read_window_documents(stream.read_top_words(spark, str(tmp_path / name)))
    return sorted(
        (int(r.window_start.timestamp() - BASE), r["rank"], r.word, r.total, r.positive, r.negative, r.neutral)
        for r in rows.withColumn("window_start", F.col("window_start")).collect()
    )


def batch_windows(spark, rows, last_end):
    df = spark.createDataFrame(
        [(i, text, BASE + at) for i, text, at in rows], f"review_id bigint, {CLEAN_TEXT} string, send_time double"
    ).withColumn("send_ts", event_time(F.col("send_time")))
    top = top_per_window(stream.windowed_words(stream.scored_records(df, LEXICON)))
    return sorted(
        (int(r.window_start.timestamp() - BASE), r["rank"], r.word, r.total, r.positive, r.negative, r.neutral)
        for r in top.collect()
        if r.window_end.timestamp() - BASE <= last_end
    )


REVIEWS = [
    (1, "good great phone", 5), (2, "bad phone and bad cable", 50), (3, "quality cable", 130),
    (4, "nothing here", 140), (5, "great great phone", 290), (6, "poor cable", 400), (7, "good but bad", 700),
    (8, "great end", 1300), (9, "great last", 2000),
]


def split(rows, size):
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def test_stream_equals_batch(spark, files, tmp_path):
    for part in split(REVIEWS, 2):
        files.reviews(*part)
    run_windows(spark, files, tmp_path)
    found = windows_of(spark, tmp_path)
    assert found == batch_windows(spark, REVIEWS, 2000 - 60) and found
    assert not [row for row in found if row[2] == "here"]  # its review holds no keyword


@pytest.mark.parametrize("options", [{"per_slide": True}, {"per_slide": False}])
def test_other_state_gives_the_same(spark, files, tmp_path, options):
    for part in split(REVIEWS, 3):
        files.reviews(*part)
    run_windows(spark, files, tmp_path, **options)
    assert windows_of(spark, tmp_path) == batch_windows(spark, REVIEWS, 2000 - 60)


def test_restart_continues_from_the_checkpoint(spark, files, tmp_path):
    parts = split(REVIEWS, 2)
    for part in parts[:2]:
        files.reviews(*part)
    run_windows(spark, files, tmp_path)
    before = windows_of(spark, tmp_path)
    for part in parts[2:]:
        files.reviews(*part)
    run_windows(spark, files, tmp_path)
    after = windows_of(spark, tmp_path)
    assert after == batch_windows(spark, REVIEWS, 2000 - 60)
    assert set(before) < set(after) and len(after) == len(set(after))


def test_out_of_order_within_the_delay_and_late(spark, files, tmp_path):
    files.reviews((1, "great one", 0), (2, "great two", 400))
    files.reviews((3, "great early", 350))  # out of order, within the delay
    files.reviews((4, "great late", 10))  # its windows are closed
    files.reviews((5, "great end", 3000))
    query = run_windows(spark, files, tmp_path)
    rows = [(1, "great one", 0), (2, "great two", 400), (3, "great early", 350), (5, "great end", 3000)]
    assert windows_of(spark, tmp_path) == batch_windows(spark, rows, 3000 - 60)
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped > 0


def test_a_failing_window_sink_fails_the_stream(spark, files, tmp_path):
    files.reviews(*REVIEWS)
    counts = stream.windowed_words(stream.scored_records(records(spark, files), LEXICON), delay="60 seconds")
    (tmp_path / "blocked").write_text("a file where the folder should be")
    query = stream.write_top_words(counts, str(tmp_path / "blocked"), str(tmp_path / "c"), state_partitions=2)
    with pytest.raises(Exception):
        query.awaitTermination()
    assert query.exception() is not None


def test_repeats_are_dropped(spark, files, tmp_path):
    files.reviews((1, "great", 0), (1, "great", 0), (2, "great", 5))
    files.reviews((2, "great", 6), (3, "great", 9))
    unique = stream.without_repeats(records(spark, files), "10 minutes")
    stream.write_rows(unique, str(tmp_path / "u"), str(tmp_path / "c"), state_partitions=2).awaitTermination()
    assert sorted(r.review_id for r in spark.read.parquet(str(tmp_path / "u")).collect()) == [1, 2, 3]


BAD = {
    "{broken": "not valid JSON",
    "plain text": "not valid JSON",
    '{"send_time": 1.0}': "no text",
    f'{{"{CLEAN_TEXT}": "x"}}': "no id",
    f'{{"review_id": 4, "{CLEAN_TEXT}": "x"}}': "no send time",
    f'{{"{CLEAN_TEXT}": "x", "send_time": "soon"}}': "not valid JSON",
}


def test_bad_records_are_set_aside(spark, files, tmp_path):
    files.add(*BAD)
    files.reviews((1, "great", 0))
    decoded = feed.decode(feed.read_feed(spark, str(files.folder), 2))
    stream.write_rows(feed.quarantined(decoded), str(tmp_path / "q"), str(tmp_path / "qc")).awaitTermination()
    assert {r.value: r.problem for r in spark.read.parquet(str(tmp_path / "q")).collect()} == BAD
    stream.write_rows(feed.good_records(decoded), str(tmp_path / "g"), str(tmp_path / "gc")).awaitTermination()
    assert [r.review_id for r in spark.read.parquet(str(tmp_path / "g")).collect()] == ["1"]


def test_all_scored_records_are_kept(spark, files, tmp_path):
    for part in split(REVIEWS, 2):
        files.reviews(*part)
    scored = stream.scored_records(records(spark, files), LEXICON)
    stream.write_rows(scored, str(tmp_path / "s"), str(tmp_path / "sc")).awaitTermination()
    rows = {r.review_id: r.category for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert rows == {1: "positive", 2: "negative", 3: "neutral", 5: "positive", 6: "neutral", 7: "neutral",
                    8: "positive", 9: "positive"}


def test_envelope_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(i, f'text "{i}"\n\\', BASE + i / 7) for i in range(3000)], f"id bigint, {CLEAN_TEXT} string, s double")
    df = df.withColumn("ts", event_time(F.col("s")))
    sent = feed.envelope(df, "id", send_time=epoch_seconds(F.col("ts")))
    feed.publish(sent, path=str(tmp_path / "out"))
    back = spark.read.schema("key string, value string").json(str(tmp_path / "out"))
    keys = {int(r.key) for r in back.select("key").distinct().collect()}
    assert min(keys) >= 0 and max(keys) <= 1000 and len(keys) > 900
    got = feed.good_records(feed.decode(back)).select("review_id", CLEAN_TEXT, "send_ts")
    want = df.select(F.col("id").cast("string").alias("review_id"), CLEAN_TEXT, F.col("ts").alias("send_ts"))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_envelope_without_a_time_is_stamped_now(spark):
    df = spark.createDataFrame([(1, "a")], f"id bigint, {CLEAN_TEXT} string")
    row = feed.good_records(feed.decode(feed.envelope(df, "id"))).first()
    assert abs(row.send_time - time.time()) < 60


def test_a_review_without_an_id_is_not_sent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], f"id bigint, {CLEAN_TEXT} string")
    with pytest.raises(Exception, match="a review without id cannot be sent"):
        feed.publish(feed.envelope(df, "id"), path=str(tmp_path / "out"))


@pytest.mark.parametrize("n, steps", [(3000, 5), (20, 3), (2, 4)])
def test_replay_steps_follow_time(spark, tmp_path, n, steps):
    df = spark.range(n).select(
        F.col("id"), F.lit("great").alias(CLEAN_TEXT),
        # A third of the reviews have the same time.
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7 % 1000)).alias("ts"),
    )
    folder, seen, whole = tmp_path / "replay", set(), []

    def step():
        new = set(folder.glob("part-*.json")) - seen
        seen.update(new)
        lines = [line for file in new for line in file.read_text().splitlines()]
        whole.append([json.loads(json.loads(line)["value"])["send_time"] for line in lines])

    feed.replay(df, "id", CLEAN_TEXT, "ts", str(folder), steps, step)
    assert len(whole) == steps and sum(map(len, whole)) == n
    whole = [times for times in whole if times]
    assert all(max(a) <= min(b) for a, b in zip(whole, whole[1:]))


def test_options_of_the_user_win(spark, files, tmp_path):
    for part in split(REVIEWS, 3):
        files.reviews(*part)
    for bound, batches in (("50", 1), ("1", 3)):
        rows = feed.decode(feed.read_feed(spark, str(files.folder), maxFilesPerTrigger=bound))
        query = stream.write_rows(rows, str(tmp_path / f"o{bound}"), str(tmp_path / f"oc{bound}"))
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p.numInputRows]) == batches


def test_a_source_that_is_no_file(spark, tmp_path):
    rows = feed.decode(feed.read_feed(spark, format="rate-micro-batch", rowsPerBatch="10"))
    query = stream.write_rows(feed.quarantined(rows), str(tmp_path / "q"), str(tmp_path / "qc"))
    query.awaitTermination()
    assert {r.problem for r in spark.read.parquet(str(tmp_path / "q")).collect()} <= {"not valid JSON", "no text"}


def test_the_filter_comes_before_the_state(spark, files):
    files.reviews((1, "great", 0))
    wanted = stream.wanted_records(records(spark, files), repeats_within="10 minutes")
    plan = wanted._jdf.queryExecution().analyzed().toString().lower()  # read from top to bottom
    assert plan.rindex("deduplicatewithinwatermark") < plan.index("contains(lower(")


def test_hot_record_is_dropped_with_and_without_salt(spark, files, tmp_path):
    hot = [(1, "great", 0)] * 500
    files.reviews(*hot, (2, "great", 1), *hot)
    files.reviews(*hot, (3, "great", 2))
    for salts in (1, 8):
        unique = stream.without_repeats(records(spark, files), "10 minutes", salts=salts)
        out = str(tmp_path / f"u{salts}")
        stream.write_rows(unique, out, str(tmp_path / f"c{salts}"), state_partitions=2).awaitTermination()
        assert sorted(r.review_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_files_are_sent_once(spark, tmp_path):
    source, sent = str(tmp_path / "source"), str(tmp_path / "sent")
    for ids in (range(5), range(5, 8)):
        spark.createDataFrame([(i, "x") for i in ids], f"review_id bigint, {CLEAN_TEXT} string").write.mode(
            "append"
        ).json(source)
        feed.publish_new_files(spark, source, "review_id", str(tmp_path / "c"), path=sent)
    rows = feed.decode(spark.read.schema("key string, value string").json(sent))
    assert sorted(r.review_id for r in rows.collect()) == [str(i) for i in range(8)]
