import json

import pytest
from pyspark.sql import functions as F

from plaudit.functions.sentiment import Lexicon
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.operators.metrics import TASK_SCHEMA
from plaudit.plans.analysis import ingest, routed_lines, run_analysis, run_sweep
from plaudit.session import work_dir
from plaudit.sizing import plan_bytes, spread
from plaudit.sources import convert, readers, writers

LEXICON = Lexicon({"good": 0.7, "bad": -0.7})
RAW = [
    '{"reviewText": "Good ONE", "asin": "x", "overall": 5.0}',
    '{"reviewText": null}',
    '{"asin": "y"}',
    '{"reviewText": "broken',
    '{"reviewText": ""}',
    "not json",
    '{"reviewText": "Ünï \\n line"}',
]


@pytest.fixture
def raw(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text("\n".join(RAW), encoding="utf-8")
    return str(path)


def test_ingest(spark, raw, tmp_path):
    result = ingest(spark, raw, str(tmp_path / "clean"))
    assert {k: result[k] for k in ("lines", "malformed", "without_text", "ingested")} == {
        "lines": 7, "malformed": 2, "without_text": 2, "ingested": 3,
    }
    clean = readers.read_parquet(spark, str(tmp_path / "clean"))
    assert clean.columns == [CLEAN_TEXT]
    assert sorted(r[0] for r in clean.collect()) == ["", "good one", "ünï \n line"]
    assert result["gib"] > 0 and result["files"] >= 1


def test_ingest_sets_bad_lines_aside(spark, raw, tmp_path):
    result = ingest(spark, raw, str(tmp_path / "out"), set_aside=True)
    assert {k: result[k] for k in ("lines", "malformed", "without_text", "ingested")} == {
        "lines": 7, "malformed": 2, "without_text": 2, "ingested": 3,
    }
    rows = readers.read_parquet(spark, str(tmp_path / "out")).collect()
    assert {r.line: r.status for r in rows if r.status != "clean"} == {
        RAW[1]: "without_text", RAW[2]: "without_text", RAW[3]: "malformed", RAW[5]: "malformed",
    }
    assert all((r.source_file or "").endswith("raw.json") == (r.status != "clean") for r in rows)
    clean = readers.read_reviews(spark, result["clean"])
    assert sorted(r[CLEAN_TEXT] for r in clean.collect()) == ["", "good one", "ünï \n line"]
    plan = routed_lines(spark, raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_ingest_failure_is_raised(spark, tmp_path):
    with pytest.raises(Exception):
        ingest(spark, str(tmp_path / "missing.json"), str(tmp_path / "clean"))


def test_json_lines_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], f"{CLEAN_TEXT} string, n int")
    writers.write_json_lines(df.coalesce(1), str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part-*.json") for x in f.read_text().splitlines()]
    assert sorted(lines, key=lambda x: x["n"]) == [{CLEAN_TEXT: "a", "n": 1}, {CLEAN_TEXT: None, "n": 2}]


def test_glob_skips_other_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "part-0.json").write_text('{"cleaned_reviewText": "a"}')
    (folder / "other.json").write_text('{"cleaned_reviewText": "b"}')
    rows = readers.read_json_lines(spark, str(folder), f"{CLEAN_TEXT} string", glob="part-*.json")
    assert [r[0] for r in rows.collect()] == ["a"]
    assert readers.list_files(spark, str(folder), ".json").count() == 2


def test_listing_reads_no_content(spark, raw):
    plan = readers.size_report(spark, raw)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<length:bigint>" in plan


def texts(spark, folder):
    rows = readers.read_json_lines(spark, f"{folder}/data", f"{CLEAN_TEXT} string")
    return sorted(r[0] for r in rows.collect())


@pytest.mark.parametrize("root", ["source", "with space", "x"])
def test_incremental_conversion(spark, tmp_path, root):
    source, target = tmp_path / root, str(tmp_path / "target")

    def add(folder, name, *values):
        spark.createDataFrame([(v, 1) for v in values], f"{CLEAN_TEXT} string, extra int").coalesce(1).write.parquet(
            str(tmp_path / "tmp" / folder / name)
        )
        (source / folder).mkdir(parents=True, exist_ok=True)
        (file,) = (tmp_path / "tmp" / folder / name).glob("part-*.parquet")
        (source / folder / f"{name}.parquet").write_bytes(file.read_bytes())

    add("x", "one", "a", "b")
    add("x", "two", "c")
    assert convert.convert_new_files(spark, str(source), target, files_per_batch=1) == 2
    assert convert.convert_new_files(spark, str(source), target) == 0
    # The same name in another folder is another file.
    add("y", "one", "d")
    (name,) = [r.source_file for r in convert.pending_files(spark, str(source), target).collect()]
    assert name.endswith("y/one.parquet") and (name == "y/one.parquet" or " " in root)
    add(f"y/{root}", "one", "e")
    assert convert.convert_new_files(spark, str(source), target) == 2
    assert convert.convert_new_files(spark, str(source), target) == 0
    assert texts(spark, target) == ["a", "b", "c", "d", "e"]


def test_conversion_repeats_after_a_lost_manifest(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.createDataFrame([("a",), ("b",), ("c",)], f"{CLEAN_TEXT} string").repartition(3).write.parquet(source)
    rows = readers.read_parquet(spark, source).select(
        CLEAN_TEXT, readers.relative_path("_metadata.file_path", source).alias("source_file")
    )
    # A run that wrote rows but died before noting them.
    writers.write_partitions(rows, f"{target}/data", "source_file", format="json")
    assert convert.convert_new_files(spark, source, target) >= 1
    assert texts(spark, target) == ["a", "b", "c"]


def write_file(spark, path, rows, schema):
    folder = path.parent / f"tmp-{path.stem}"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(folder))
    (file,) = folder.glob("part-*.parquet")
    path.write_bytes(file.read_bytes())
    for left in folder.iterdir():
        left.unlink()
    for left in folder.parent.glob(f"tmp-{path.stem}/.*"):
        left.unlink()
    folder.rmdir()


@pytest.mark.parametrize("types", [("bigint", "bigint"), ("bigint", "string")])
def test_files_of_other_schemas_and_rewritten_files(spark, tmp_path, types):
    source, target = tmp_path / "source", str(tmp_path / "target")
    source.mkdir()
    write_file(spark, source / "a.parquet", [("a",)], f"{CLEAN_TEXT} string")
    for name, kind in zip("bc", types):
        own = 7 if kind == "bigint" else "seven"
        write_file(spark, source / f"{name}.parquet", [(own, name), (None, name * 2)], f"review_id {kind}, {CLEAN_TEXT} string")

    def converted():
        rows = readers.read_json_lines(spark, f"{target}/data", f"review_id string, {CLEAN_TEXT} string").collect()
        return {r[CLEAN_TEXT]: r.review_id for r in rows}

    assert convert.convert_new_files(spark, str(source), target) == 3
    ids = {"a": "a.parquet:0", "b": "7", "bb": "b.parquet:1", "c": "7" if types[1] == "bigint" else "seven", "cc": "c.parquet:1"}
    assert converted() == ids and convert.convert_new_files(spark, str(source), target) == 0
    write_file(spark, source / "b.parquet", [(9, "other")], f"review_id bigint, {CLEAN_TEXT} string")
    assert [r.source_file for r in convert.pending_files(spark, str(source), target).collect()] == ["b.parquet"]
    assert convert.convert_new_files(spark, str(source), target) == 1
    assert converted() == {"a": ids["a"], "other": "9", "c": ids["c"], "cc": ids["cc"]}
    # A manifest of many files becomes one that says the same.
    convert.compact_manifest(spark, target, most_files=1)
    assert len(list((tmp_path / "target" / "_manifest").glob("run=*"))) == 1
    assert convert.convert_new_files(spark, str(source), target) == 0


def test_streamed_conversion(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    for values in (["a", None], ["b"], []):
        if values:
            spark.createDataFrame([(v,) for v in values], f"{CLEAN_TEXT} string").coalesce(1).write.mode("append").parquet(source)
        convert.convert_stream(spark, source, target, checkpoint)
    rows = readers.read_json_lines(spark, target, f"{CLEAN_TEXT} string")
    assert sorted(str(r[0]) for r in rows.collect()) == ["None", "a", "b"]


def test_partitions_of_other_runs_stay(spark, tmp_path):
    folder = str(tmp_path / "runs")
    writers.write_partitions(spark.createDataFrame([("a", 20), ("b", 40)], "w string, pct int"), folder, "pct")
    writers.write_partitions(spark.createDataFrame([("c", 40)], "w string, pct int"), folder, "pct")
    assert sorted(tuple(r) for r in spark.read.parquet(folder).collect()) == [("a", 20), ("c", 40)]


def test_report_is_one_file(spark, tmp_path):
    writers.write_report(spark.range(5).repartition(3), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*.json"))) == 1


def reviews(spark, folder):
    rows = [(i, text) for i, text in enumerate(["good day", "bad day", "day", " ", None, "n/a", "good good"])]
    spark.createDataFrame(rows, f"id bigint, {CLEAN_TEXT} string").write.parquet(folder)


@pytest.mark.parametrize("options", [{}, {"partitions": 5}, {"keep_in_memory": True, "sort_words": True}])
def test_run_analysis(spark, tmp_path, options):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    reviews(spark, source)
    row = run_analysis(spark, source, target, lexicon=LEXICON, placeholders=["n/a"], **options).first()
    assert (row.pct, row.total_records, row.positive_count, row.negative_count, row.neutral_count) == (100, 4, 2, 1, 1)
    assert row.avg_sentiment == pytest.approx(0.175) and row.records_per_second > 0 and row.partition_count >= 1
    assert row.total_seconds == pytest.approx(
        row.read_seconds + row.words_seconds + row.sentiment_seconds + row.save_seconds
    )
    words = spark.read.parquet(f"{target}/word_frequency")
    assert {r.word: r.frequency for r in words.collect()} == {"good": 3, "day": 3, "bad": 1}
    tasks = {r.task: r for r in spark.read.schema(TASK_SCHEMA).json(f"{target}/tasks").collect()}
    assert list(tasks) == ["read", "words", "save", "sentiment"]
    assert sum(r.seconds for r in tasks.values()) == pytest.approx(row.total_seconds)
    assert tasks["words"].output_rows == 3 and tasks["sentiment"].output_rows == 4 and tasks["save"].output_rows == 6
    assert all(tasks[name].tasks > 0 and tasks[name].output_bytes > 0 for name in ("words", "sentiment", "save"))
    top = [json.loads(x) for f in (tmp_path / "t" / "top_words" / "pct=100").glob("part-*") for x in f.read_text().splitlines()]
    assert top == [{"word": "day", "frequency": 3}, {"word": "good", "frequency": 3}, {"word": "bad", "frequency": 1}]
    scored = spark.read.parquet(f"{target}/sentiment")
    assert sorted(scored.columns) == sorted([CLEAN_TEXT, "compound", "category", "pct"]) and scored.count() == 4
    assert spark.read.json(f"{target}/categories").count() == 3
    assert spark.read.json(f"{target}/metrics").count() == 1


def test_run_analysis_of_samples(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(2000).select(F.col("id"), F.lit("good day").alias(CLEAN_TEXT)).write.parquet(source)
    for options in ({"percent": 20, "key": "id"}, {"percent": 40, "seed": 5}):
        row = run_analysis(spark, source, target, lexicon=LEXICON, **options).first()
        # Both passes saw the same sample.
        words = spark.read.parquet(f"{target}/word_frequency").filter(F.col("pct") == options["percent"])
        assert {r.frequency for r in words.collect()} == {row.total_records}
    assert {r.pct for r in spark.read.parquet(f"{target}/sentiment").select("pct").distinct().collect()} == {20, 40}


def test_run_analysis_of_the_first_rows(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(50).select(F.col("id"), F.lit("good day").alias(CLEAN_TEXT)).write.parquet(source)
    assert run_analysis(spark, source, target, key="id", limit=7, lexicon=LEXICON).first().positive_count == 7
    with pytest.raises(ValueError):
        run_analysis(spark, source, target, limit=7)


def test_run_sweep(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(500).select(F.col("id"), F.lit("good day").alias(CLEAN_TEXT)).write.parquet(source)
    run_sweep(spark, source, target, "id", lexicon=LEXICON)
    metrics = {r.pct: r for r in spark.read.json(f"{target}/metrics").collect()}
    words = {(r.pct, r.word): r.frequency for r in spark.read.parquet(f"{target}/word_frequency").collect()}
    assert set(metrics) == {20, 40, 60, 80, 100} and metrics[100].total_records == 500
    for pct, row in metrics.items():
        assert words[pct, "good"] == row.total_records == row.positive_count


def test_spread(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert plan_bytes(df) < 1 << 20
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = str(tmp_path / "many")
    spark.range(1000).repartition(spark.sparkContext.defaultParallelism).write.parquet(many)
    for busy in (spark.read.parquet(many), spark.range(10**12)):
        assert spread(busy) is busy


def test_work_dir_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "a"), work_dir(spark, "a")
    assert first.startswith(base) and second.startswith(base) and first != second


def test_a_few_partitions_are_written_without_a_sort(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "concat('s', id % 3) status").repartition(4)
    for few, folder in ((3, "few"), (0, "many")):
        with Plans(spark) as plans:
            writers.write_partitions(df, str(tmp_path / folder), "status", few=few)
        assert any("Sort" in plan for plan in plans.seen) == (few == 0)
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / folder)).collect())) == sorted(map(tuple, df.collect()))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


class Plans:
    """The plans of the commands that run in a block."""

    def __init__(self, spark):
        self.spark, self.seen = spark, []

    def __enter__(self):
        self.store = self.spark._jsparkSession.sharedState().statusStore()
        self.before = self.store.executionsCount()
        return self

    def __exit__(self, *_):
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        runs = self.store.executionsList()
        self.seen = [runs.apply(i).physicalPlanDescription() for i in range(self.before, runs.size())]


def test_mixed_files_of_several_parts(spark, tmp_path, monkeypatch):
    from plaudit.catalog import queries

    rows = [(i, f"Text {i} " + "x" * 50, "en" if i % 2 else None) for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "FILE_BYTES", 4_000)
    written = []
    monkeypatch.setattr(queries.convert, "convert_new_files", lambda spark, source, target, f=queries.convert.convert_new_files: written.append(
        len(queries._files(spark, f"{source}/c"))) or f(spark, source, target))
    found = queries.mixed_files_convert(spark, str(tmp_path)).collect()
    assert written[0] == written[1] > 1
    expected = [(None, t.lower()) for _, t, lang in rows if lang is None] + [(f"doc {i}", t.lower()) for i, t, lang in rows if lang]
    expected += [(str(i), t.lower()) for i, t, _ in rows if i % 3 == 1]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
