"""The commands one after the other, as a user of the pipeline runs them."""

import json

from plaudit.__main__ import main
from plaudit.streaming.run import batches, read_scored, read_set_aside, read_windows


def test_pipeline(spark, tmp_path, capsys):
    def run(*args):
        main([str(a) for a in args], spark)
        out = capsys.readouterr().out.strip().splitlines()
        return json.loads(out[-1]) if out else None

    raw = tmp_path / "raw.json"
    raw.write_text("\n".join(json.dumps({"reviewText": t}) for t in ["Great phone", "Bad cable", "Nothing", "bad"]))
    assert run("ingest", raw, tmp_path / "clean")["ingested"] == 4
    result = run("analyze", tmp_path / "clean", tmp_path / "results")
    assert (result["positive_count"], result["negative_count"], result["neutral_count"]) == (1, 2, 1)
    assert run("convert", tmp_path / "clean", tmp_path / "json")["converted_files"] >= 1
    assert run("convert", tmp_path / "clean", tmp_path / "json")["converted_files"] == 0
    assert run("size", tmp_path / "clean", "--suffix", ".parquet")["bytes"] > 0

    # The README's order, with nothing by hand between the steps: ids come from the clean files.
    run("sweep", tmp_path / "clean", tmp_path / "sweep", "--key", "review_id")
    assert spark.read.json(str(tmp_path / "sweep" / "metrics")).count() == 5
    for sent in ("p1", "p2"):
        run("publish", tmp_path / "json" / "data", "--checkpoint", tmp_path / sent, "--option", f"path={tmp_path / 'feed' / sent}")
    assert spark.read.json(str(tmp_path / "feed" / "*")).count() == 8
    run("stream", tmp_path / "feed" / "*", tmp_path / "out", "--checkpoint", tmp_path / "sc", "--state-partitions", 2,
        "--drop-repeats", "--delay", "1 day")
    scored = read_scored(spark, str(tmp_path / "out"))
    assert {r.category: r["count"] for r in scored.groupBy("category").count().collect()} == {"positive": 1, "negative": 2}
    assert scored.select("review_id").distinct().count() == 3 and scored.filter("review_id is null").count() == 0
    assert read_set_aside(spark, str(tmp_path / "out")).count() == 0
    assert {r.repeats for r in batches(spark, str(tmp_path / "out")).collect()} == {3}

    # The same run cached and uncached, compared by task.
    assert result["total_records"] == 4
    run("analyze", tmp_path / "clean", tmp_path / "results", "--mode", "parallel", "--keep-in-memory")
    run("analyze", tmp_path / "clean", tmp_path / "results", "--mode", "sequential", "--key", "review_id",
        "--limit", 1000, "--no-keep-in-memory")
    run("compare", tmp_path / "results" / "run_log", tmp_path / "compared")
    rows = {r.task: r for r in spark.read.json(str(tmp_path / "compared")).collect()}
    assert set(rows) == {"read", "words", "sentiment", "save", "total"} and all(r.speedup > 0 for r in rows.values())


def test_an_id_of_the_raw_lines_is_kept(spark, tmp_path, capsys):
    raw = tmp_path / "raw.json"
    raw.write_text("\n".join(json.dumps({"reviewText": "Great", "asin": f"x{i}"}) for i in range(3)))
    main([str(a) for a in ("ingest", raw, tmp_path / "clean", "--id", "asin")], spark)
    main([str(a) for a in ("convert", tmp_path / "clean", tmp_path / "json")], spark)
    rows = spark.read.schema("review_id string").json(str(tmp_path / "json" / "data"))
    assert sorted(r.review_id for r in rows.collect()) == ["x0", "x1", "x2"]


def test_a_lexicon_too_long_for_a_task_is_joined(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr("plaudit.__main__.IN_MEMORY_WORDS", 1)
    raw = tmp_path / "raw.json"
    raw.write_text("\n".join(json.dumps({"reviewText": t}) for t in ["good", "very bad", "none"]))
    spark.createDataFrame([("good", 0.5), ("bad", -0.5)], "word string, polarity double").write.parquet(str(tmp_path / "lex"))
    main([str(a) for a in ("ingest", raw, tmp_path / "clean")], spark)
    main([str(a) for a in ("analyze", tmp_path / "clean", tmp_path / "out", "--lexicon", tmp_path / "lex")], spark)
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (result["positive_count"], result["negative_count"], result["neutral_count"]) == (1, 1, 1)


def test_a_stream_takes_a_lexicon_too_long_for_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("plaudit.__main__.IN_MEMORY_WORDS", 1)
    folder = tmp_path / "feed"
    folder.mkdir()
    value = json.dumps({"review_id": 1, "cleaned_reviewText": "great phone", "send_time": 1_700_000_000.0})
    (folder / "0.json").write_text(json.dumps({"key": "1", "value": value}))
    spark.createDataFrame([("phone", -0.5), ("cable", -0.5)], "word string, polarity double").write.parquet(str(tmp_path / "lex"))
    main([str(a) for a in ("stream", folder, tmp_path / "out", "--checkpoint", tmp_path / "c", "--lexicon", tmp_path / "lex")], spark)
    assert [(r.review_id, r.category) for r in read_scored(spark, str(tmp_path / "out")).collect()] == [("1", "negative")]


def test_windows_appear_once_time_passes(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    for n, at in enumerate((0, 3600)):
        value = json.dumps({"review_id": n, "cleaned_reviewText": "great phone", "send_time": 1_700_000_000.0 + at})
        (folder / f"{n}.json").write_text(json.dumps({"key": "1", "value": value}))
    args = ["stream", folder, tmp_path / "out", "--checkpoint", tmp_path / "c", "--state-partitions", 2, "--drop-repeats"]
    main([str(a) for a in args], spark)
    rows = read_windows(spark, str(tmp_path / "out")).collect()
    assert len(rows) == 5 and {w.word for r in rows for w in r.top_words} == {"great", "phone"}
