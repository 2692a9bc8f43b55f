"""Command line: ``python -m plaudit <command>``, or the same through spark-submit."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.functions import presets
from plaudit.functions.sentiment import IN_MEMORY_WORDS, Lexicon
from plaudit.operators import metrics
from plaudit.operators.ingest import CLEAN_TEXT
from plaudit.operators.scoring import lexicon_table
from plaudit.plans import analysis
from plaudit.session import build_session
from plaudit.sizing import is_small
from plaudit.sources import convert, readers
from plaudit.streaming import feed
from plaudit.streaming.run import FeedRun


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def load_lexicon(spark: SparkSession, args: argparse.Namespace) -> Lexicon | DataFrame | None:
    """Word lists from Parquet tables, as a table if they are too many for one task; the starter lists if none are given."""
    if not args.lexicon:
        return None
    tables = [spark.read.parquet(path) if path else None for path in (args.lexicon, args.modifiers, args.negations)]
    table = lexicon_table(*tables)
    return Lexicon.from_table(table) if is_small(table, IN_MEMORY_WORDS) else table


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps(analysis.ingest(spark, args.source, args.target, id_column=args.id, set_aside=args.set_aside)))


def analyze(spark: SparkSession, args: argparse.Namespace) -> None:
    result = analysis.run_analysis(
        spark,
        args.source,
        args.target,
        percent=args.percent,
        key=args.key,
        seed=args.seed,
        limit=args.limit,
        lexicon=load_lexicon(spark, args),
        placeholders=args.placeholder,
        partitions=args.partitions,
        keep_in_memory=args.keep_in_memory,
    )
    if args.mode:
        log = metrics.run_log(result, f"{args.percent}", args.mode)
        log.coalesce(1).write.mode("append").json(f"{args.target}/run_log")
    print(json.dumps(result.first().asDict()))


def sweep(spark: SparkSession, args: argparse.Namespace) -> None:
    analysis.run_sweep(spark, args.source, args.target, args.key, args.percents, load_lexicon(spark, args))


def to_json(spark: SparkSession, args: argparse.Namespace) -> None:
    count = convert.convert_new_files(spark, args.source, args.target, files_per_batch=args.files_per_batch)
    print(json.dumps({"converted_files": count}))


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    feed.publish_new_files(
        spark,
        args.source,
        args.key,
        args.checkpoint,
        schema=f"{args.key} string, {CLEAN_TEXT} string",
        files_per_batch=args.files_per_batch,
        pause=args.pause,
        format=args.format,
        **_pairs(args.option),
    )


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scored records, set-aside records and top words per window, from one reading of the feed."""
    if args.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.state_partitions)
    run = FeedRun(
        args.target, load_lexicon(spark, args), tuple(args.keywords), seconds(spark, args.delay), drop_repeats=args.drop_repeats
    )
    records = feed.read_feed(spark, args.source, format=args.format, **_pairs(args.option))
    run.start(records, args.checkpoint, args.every).awaitTermination()


def seconds(spark: SparkSession, span: str) -> int:
    """A time span such as "2 minutes" in seconds."""
    return spark.range(1).select((F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {span}"))).alias("s")).first().s


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    log = readers.read_json_lines(spark, args.source, "mode string, task string, seconds double")
    rows = metrics.run_comparison(log, "task", "mode", "seconds", args.base, args.other)
    rows.write.mode("overwrite").json(args.target)


def size(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps(readers.size_report(spark, args.source, args.suffix).first().asDict()))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="plaudit")
    commands = top.add_subparsers(required=True, dest="command")

    def command(run, name: str, *, target: bool = True, lexicon: bool = False, source: dict | None = None) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        sub.add_argument("source", **(source or {}))
        if target:
            sub.add_argument("target")
        if lexicon:
            sub.add_argument("--lexicon", help="Parquet table (word, polarity)")
            sub.add_argument("--modifiers", help="Parquet table (word, intensity)")
            sub.add_argument("--negations", help="Parquet table (word)")
        return sub

    sub = command(ingest, "ingest")
    sub.add_argument("--id", help="field that holds a unique id; without it a review is known by its place in the clean files")

    sub.add_argument("--set-aside", action="store_true", help="keep lines that cannot be used, beside the clean ones in target/status=clean")

    sub = command(analyze, "analyze", lexicon=True)
    sub.add_argument("--percent", type=int, default=100)
    sub.add_argument("--key", help="draw the sample by the hash of this column")
    sub.add_argument("--seed", type=int, default=0)
    sub.add_argument("--limit", type=int, help="keep only the rows with the smallest keys")
    sub.add_argument("--mode", help="note the run's times under this name, for the compare command")
    sub.add_argument("--placeholder", action="append", default=[])
    sub.add_argument("--partitions", type=int)
    sub.add_argument("--keep-in-memory", action=argparse.BooleanOptionalAction, help="by default an input too small to busy all cores is kept")

    sub = command(sweep, "sweep", lexicon=True)
    sub.add_argument("--key", required=True)
    sub.add_argument("--percents", type=int, nargs="+", default=list(presets.FRACTIONS))

    sub = command(to_json, "convert")
    sub.add_argument("--files-per-batch", type=int, help="by default as many as the cluster takes")

    sub = command(publish, "publish", target=False)
    sub.add_argument("--key", default="review_id")
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--files-per-batch", type=int, help="by default as many as the cluster takes")
    sub.add_argument("--pause", help="time between batches; without it the run ends when all is sent")
    sub.add_argument("--format", default="json")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    sub = command(stream, "stream", lexicon=True, source={"nargs": "?", "help": "a folder of files; none for a message log"})
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--keywords", nargs="+", default=list(presets.STREAM_KEYWORDS))
    sub.add_argument("--delay", default="2 minutes")
    sub.add_argument("--every", help="trigger interval such as '60 seconds'; without it the run ends when done")
    sub.add_argument("--drop-repeats", action="store_true")
    sub.add_argument("--state-partitions", type=int)
    sub.add_argument("--format", default="json")
    sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    sub = command(compare, "compare")
    sub.add_argument("--base", default="sequential")
    sub.add_argument("--other", default="parallel")

    sub = command(size, "size", target=False)
    sub.add_argument("--suffix", default="")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"plaudit-{args.command}"), args)


if __name__ == "__main__":
    main()
