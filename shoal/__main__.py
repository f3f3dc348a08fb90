"""Command line: run a profile's two streaming queries, or repair tables.

    python -m shoal run e7 --topic device-events --root s3://bucket/shoal/e7 \\
        --table-name events_v7 --trigger-seconds 60 --starting-offsets latest \\
        --max-offsets 5000000 --kafka-option kafka.bootstrap.servers=host:9092
    python -m shoal run m5 --root hdfs:///shoal/m5 --source-format text --source-path /data/in --available-now
    python -m shoal repair events_v7,metrics_v5
    python -m shoal replay e7 --root s3://bucket/shoal/e7 --table-name events_v7
    python -m shoal stop --root s3://bucket/shoal/e7
    python -m shoal compact e7 --root s3://bucket/shoal/e7 --table-name events_v7

Every setting of the eight stream entry points is a named option here (start offsets,
checkpoint/data root, table name, rate limits, poll time, trigger, clean start); the
profile name picks what differs between them.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from shoal.plans.profiles import PROFILES
from shoal.session import configure
from shoal.sources.stream import SourceOptions, read_allow_list
from shoal.streaming.catalog import repair_tables
from shoal.streaming.compaction import Compactor
from shoal.streaming.jobs import ProfileStream, StreamPaths, request_stop
from shoal.streaming.keys import KeyRegistry
from shoal.streaming.sinks import TableWriter


def _key_values(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items:
        key, sep, value = item.partition("=")
        if not sep:
            raise argparse.ArgumentTypeError(f"expected key=value, got {item!r}")
        out[key] = value
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m shoal")
    sub = ap.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run", help="run a profile's stage-1 and stage-2 queries")
    run.add_argument("profile", choices=sorted(PROFILES))
    run.add_argument("--root", required=True, help="data and checkpoint root, on storage that the whole cluster shares")
    run.add_argument("--table-name", help="catalog table kept in step with the Parquet files")
    run.add_argument("--source-format", default="kafka", help="kafka (default) or text")
    run.add_argument("--topic")
    run.add_argument("--source-path", help="directory of a file source")
    run.add_argument("--starting-offsets")
    run.add_argument("--max-offsets", type=int, help="maxOffsetsPerTrigger")
    run.add_argument("--min-offsets", type=int, help="minOffsetsPerTrigger")
    run.add_argument("--max-trigger-delay", help="e.g. 15m")
    run.add_argument("--max-files", type=int, help="maxFilesPerTrigger of a file source")
    run.add_argument("--poll-ms", type=int, help="Kafka consumer poll timeout")
    run.add_argument("--kafka-option", action="append", default=[], help="key=value, repeatable")
    run.add_argument("--trigger-seconds", type=int, default=60)
    run.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    run.add_argument("--clean-start", action="store_true", help="new checkpoint generation")
    run.add_argument("--layout", default="source", choices=["source", "salted"])
    run.add_argument("--files-per-hour", type=int, help="writers of an hour in the salted layout (default: the cluster's parallelism)")
    run.add_argument("--allow-list", help="CSV file whose first line lists the allowed names")
    run.add_argument("--live-allow-list", help="such a file, or a folder of its versions, read anew for every batch")
    run.add_argument("--seen-within", help="drop what a device sends again within this time, e.g. '2 hours'")
    run.add_argument("--typed", action="store_true", help="gather the types of the payload's columns")
    run.add_argument("--choose-columns", metavar="REST", help="columns for frequent payload keys only, the others in column REST")
    run.add_argument("--max-behind", type=int, help="stop when a Kafka source has more records waiting")
    run.add_argument("--log-level", default="WARN")

    rep = sub.add_parser("repair", help="register the partitions of tables (comma separated)")
    rep.add_argument("tables")

    rpl = sub.add_parser("replay", help="load quarantined batches of a profile into its table")
    rpl.add_argument("profile", choices=sorted(PROFILES))
    rpl.add_argument("--root", required=True, help="the root the stream runs under")
    rpl.add_argument("--table-name")

    stp = sub.add_parser("stop", help="ask the job under a root to stop in good order")
    stp.add_argument("--root", required=True)

    cmp = sub.add_parser("compact", help="rewrite the small files of a profile's table")
    cmp.add_argument("profile", choices=sorted(PROFILES))
    cmp.add_argument("--root", required=True)
    cmp.add_argument("--table-name")
    cmp.add_argument("--target-mb", type=int, default=128)
    return ap


def build_job(spark: SparkSession, args: argparse.Namespace) -> ProfileStream:
    options = _key_values(args.kafka_option)
    if args.poll_ms is not None:
        options["kafkaConsumer.pollTimeoutMs"] = str(args.poll_ms)
    source = SourceOptions(
        format=args.source_format,
        topic=args.topic,
        path=args.source_path,
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets,
        min_offsets_per_trigger=args.min_offsets,
        max_trigger_delay=args.max_trigger_delay,
        max_files_per_trigger=args.max_files,
        options=options,
    )
    paths = StreamPaths.open(spark, args.root, clean_start=args.clean_start)
    p = PROFILES[args.profile]
    if args.allow_list:
        p = p.with_options(allow_list=tuple(r["name"] for r in read_allow_list(spark, args.allow_list).collect()))
    p = p.with_options(seen_within=args.seen_within)
    job = ProfileStream(spark, p, source, paths, table_name=args.table_name, layout=args.layout,
                        files_per_hour=args.files_per_hour, max_behind=args.max_behind, typed=args.typed)
    job.writer.allow_list_path = args.live_allow_list
    if args.choose_columns:
        job.writer.registry = KeyRegistry(spark, paths.keys, rest_column=args.choose_columns)
    return job


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"shoal-{args.command}").getOrCreate()
    configure(spark)
    if args.command == "repair":
        for name in repair_tables(spark, args.tables):
            print(f"repaired {name}")
        return 0
    if args.command == "replay":
        paths = StreamPaths.open(spark, args.root)
        writer = TableWriter(PROFILES[args.profile], paths.table, paths.generation, args.table_name, paths.quarantine)
        for tag in writer.replay(spark):
            print(f"replayed {tag}")
        return 0
    if args.command == "stop":
        request_stop(spark, StreamPaths.open(spark, args.root))
        return 0
    if args.command == "compact":
        table = StreamPaths.open(spark, args.root).table
        n = Compactor(spark, PROFILES[args.profile], table, args.table_name, target=args.target_mb << 20).run()
        print(f"compacted {n} directories")
        return 0
    spark.sparkContext.setLogLevel(args.log_level)
    job = build_job(spark, args)
    if args.available_now:
        job.run_available_now()
    else:
        job.run_forever(args.trigger_seconds)
    return 0


if __name__ == "__main__":
    sys.exit(main())
