"""Command line: run the streaming pipeline, replay dead letters, apply retention, rewrite days."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timedelta, timezone

from gaugeline.operators.retention import ARCHIVE_DAYS
from gaugeline.session import spark_session
from gaugeline.sources.archive import BUCKET_LAYOUT, BUCKETS, WELL_LAYOUT
from gaugeline.sources.kafka import read_message_files, read_messages
from gaugeline.streaming import jobs, rewrite
from gaugeline.streaming.supervise import ProgressLog

LAYOUTS = {"well": WELL_LAYOUT, "bucket": BUCKET_LAYOUT}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--base", required=True, help="folder of the tables, shared by the cluster")
    common.add_argument("--layout", choices=LAYOUTS, default="bucket")
    common.add_argument("--buckets", type=int, default=BUCKETS)

    parser = argparse.ArgumentParser(prog="gaugeline", description=__doc__)
    jobs_of = parser.add_subparsers(dest="job", required=True)

    stream = jobs_of.add_parser("stream", parents=[common], help="messages to all tables")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--broker", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of Parquet files with Kafka-shaped rows")
    stream.add_argument("--topic")
    stream.add_argument("--starting", default="latest", help="startingOffsets of the first run")
    stream.add_argument("--min-partitions", type=int)
    stream.add_argument("--max-offsets", type=int)
    stream.add_argument("--log-retention", help="age at which files leave a sink's log, such as 100d")
    stream.add_argument("--progress", help="folder for the progress and failures of the queries")
    stream.add_argument("--trigger", default="1 minute", help="time between batches, or 'once'")

    jobs_of.add_parser("replay", parents=[common], help="bring back dead letters that parse now")

    keep = jobs_of.add_parser("retain", parents=[common], help="remove expired days")
    keep.add_argument("--archive-days", type=int, default=ARCHIVE_DAYS["other"])
    keep.add_argument(
        "--consumers",
        nargs="*",
        default=["anomalies", "points", "breaches", "alerts"],
        help="tables whose streams are in use; days they have not read stay",
    )
    keep.add_argument("--as-of", type=datetime.fromisoformat, default=None)
    keep.add_argument("--grace-hours", type=float, default=24, help="how long reads may take that have begun")

    pack = jobs_of.add_parser("compact", parents=[common], help="rewrite closed days in large sorted files")
    pack.add_argument("--consumers", nargs="*", default=["anomalies", "points", "breaches", "alerts"])
    pack.add_argument("--as-of", type=datetime.fromisoformat, default=None)
    pack.add_argument("--grace-hours", type=float, default=24, help="how long reads may take that have begun")

    again = jobs_of.add_parser("backfill", parents=[common], help="detect again over archived days")
    again.add_argument("--first", type=date.fromisoformat, required=True)
    again.add_argument("--last", type=date.fromisoformat, required=True)
    again.add_argument("--consumers", nargs="*", default=["anomalies", "breaches", "alerts"])

    args = parser.parse_args(argv)
    if args.job == "stream" and args.broker and not args.topic:
        parser.error("--broker needs --topic")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = spark_session(f"gaugeline-{args.job}")
    pipeline = jobs.Pipeline(
        args.base,
        layout=LAYOUTS[args.layout],
        buckets=args.buckets,
        log_retention=getattr(args, "log_retention", None),
    )
    if args.job == "replay":
        jobs.replay(spark, pipeline)
    elif args.job == "retain":
        as_of = args.as_of or datetime.now(timezone.utc)
        grace = timedelta(hours=args.grace_hours)
        for folder in jobs.drop_old(spark, pipeline, as_of, args.archive_days, args.consumers, grace):
            print(f"removed {folder}")
    elif args.job == "compact":
        as_of = args.as_of or datetime.now(timezone.utc)
        grace = timedelta(hours=args.grace_hours)
        for folder in rewrite.compact(spark, pipeline, as_of, consumers=args.consumers, grace=grace):
            print(f"rewritten {folder}")
    elif args.job == "backfill":
        rewrite.backfill(spark, pipeline, args.first, args.last, consumers=args.consumers)
    else:
        if args.progress:
            spark.streams.addListener(ProgressLog(spark, args.progress))
        if args.files:
            messages = read_message_files(spark, args.files)
        else:
            messages = read_messages(
                spark, args.broker, args.topic, args.starting, args.min_partitions, args.max_offsets
            )
        if args.trigger == "once":
            jobs.run_once(spark, messages, pipeline)
        else:
            jobs.start_all(spark, messages, jobs.with_trigger(pipeline, processingTime=args.trigger))
            jobs.await_any(spark)


if __name__ == "__main__":
    main()
