"""Command line: ``python -m cartspark <job> ...`` or ``spark-submit`` with this file."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartspark import operators as ops
from cartspark import plans
from cartspark.session import build_session
from cartspark.sources import read_events


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cartspark", description="Cart-abandonment analytics on Spark.")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *, events: bool = True, output: bool = True):
        one = jobs.add_parser(name, help=text)
        if events:
            one.add_argument("--input", required=True, help="event file or folder")
            one.add_argument("--input-format", default="csv", choices=["csv", "json", "parquet", "orc"])
        if output:
            one.add_argument("--output", required=True, help="folder of the results")
            one.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
        return one

    job("profile", "show a sample, counts, missing values and top products", output=False)
    job("batch", "summary, top products and hourly trends of the full history")
    speed = job("speed", "sliding windows over the events")
    speed.add_argument("--window-minutes", type=int, default=5)
    speed.add_argument("--limit", type=int, help="use the first events only")
    job("serve", "merge the batch and speed results", events=False)
    publish = job("publish", "events as keyed JSON records")
    publish.add_argument("--limit", type=int, help="use the first events only")
    archive = job("archive", "drain a folder of event files into a JSON lines archive", output=False)
    archive.add_argument("--output", required=True)
    archive.add_argument("--checkpoint", help="needed unless there is a limit")
    archive.add_argument("--limit", type=int, help="archive so many records; without a checkpoint, the first ones only")
    archive.add_argument("--by-date", action="store_true", help="divide the archive by event date")
    archive.add_argument("--max-files", type=int, help="files per micro-batch")
    history = job("history", "count what is new in an archive into the history, and report from that", events=False)
    history.add_argument("--archive", required=True)
    history.add_argument("--history", required=True, help="folder of the stored history")
    history.add_argument("--max-parts", type=int, help="parts of the archive to count at most")
    closed = job("stream-windows", "drain a folder of event files into sliding windows", output=False)
    closed.add_argument("--window-minutes", type=int, default=5)
    estimates = job("stream-estimates", "drain a folder of record files into an estimate per micro-batch", output=False)
    estimates.add_argument("--dead-letters", help="folder for the records that cannot be decoded")
    sending = job("stream-publish", "drain a folder of event files into keyed JSON records", output=False)
    sending.add_argument("--largest", type=int, help="bytes of a record that the receiver takes at most")
    for stream in (closed, estimates, sending):
        stream.add_argument("--output", required=True)
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--max-files", type=int, help="files per micro-batch")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"cartspark-{args.job}")
    if args.job == "archive":
        archived, rejected = plans.archive(
            spark,
            args.input,
            args.output,
            args.checkpoint,
            args.input_format,
            args.limit,
            args.max_files,
            by_date=args.by_date,
        )
        print(f"records archived: {archived}, rejected: {rejected}")
        return
    if args.job == "history":
        counted = plans.update_history(spark, args.archive, args.history, args.max_parts)
        print(f"parts counted: {counted}")
        plans.history_report(spark, args.history, args.output, args.format)["batch_summary"].show(truncate=False)
        ops.approximate_uniques(plans.read_sketches(spark, args.history)).show(truncate=False)
        return
    if args.job == "stream-windows":
        windows = plans.stream_windows(
            spark, args.input, args.output, args.checkpoint, args.input_format, args.window_minutes, args.max_files
        )
        ops.recent_windows(windows).show(truncate=False)
        return
    if args.job == "stream-estimates":
        plans.stream_estimates(
            spark, args.input, args.output, args.checkpoint, args.input_format, args.dead_letters, args.max_files
        ).show(truncate=False)
        return
    if args.job == "stream-publish":
        plans.stream_publish(
            spark, args.input, args.output, args.checkpoint, args.input_format, args.largest, args.max_files
        ).show(truncate=False)
        return
    if args.job == "serve":
        for table in plans.serving_report(spark, args.output, args.format):
            table.show(truncate=False)
        return
    events = read_events(spark, args.input, args.input_format)
    if args.job == "profile":
        tables = plans.profile_report(events)
        if args.input_format in ("csv", "json"):
            tables |= plans.scan_report(spark, args.input, args.input_format)
        for name, table in tables.items():
            print(name)
            table.show(truncate=False)
    elif args.job == "batch":
        plans.batch_report(spark, events, args.output, args.format)["batch_summary"].show(
            truncate=False
        )
    elif args.job == "speed":
        windows = plans.speed_report(
            spark, events, args.output, args.format, args.window_minutes, args.limit
        )
        ops.recent_windows(windows).show(truncate=False)
    else:
        tally = Observation()
        records = plans.publish(events, args.limit).observe(
            tally, F.count(F.lit(1)).alias("sent"), F.count_if(F.col("key").isNull()).alias("unkeyed")
        )
        records.write.mode("overwrite").format(args.format).save(args.output)
        print("records sent: {sent}, without a key: {unkeyed}".format(**tally.get))


if __name__ == "__main__":
    main()
