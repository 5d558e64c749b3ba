"""Runs an ingest job: provision the table, wait for a valid message, stream.

    spark-submit --packages <kafka source> ... -m quotemill trades \\
        --servers kafka:9092 --checkpoint s3a://bucket/offsets --table
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from quotemill.operators.gate import wait_on_stream
from quotemill.session import build_session, scratch_path, storage_from_env
from quotemill.sources.feeds import DATABASE, FEEDS, feed
from quotemill.sources.topics import FileTopics, KafkaTopics
from quotemill.streaming import sinks
from quotemill.streaming.jobs import ingest, run


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quotemill", description=__doc__.splitlines()[0])
    parser.add_argument("feed", choices=sorted(FEEDS))
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--servers", default="kafka:9092", help="Kafka bootstrap servers")
    source.add_argument("--files", help="read messages from files instead")
    parser.add_argument("--group-id", help="consumer group")
    parser.add_argument("--protocol", default="PLAINTEXT", help="security protocol of the brokers")
    parser.add_argument("--min-partitions", type=int, help="least tasks that read a topic")
    parser.add_argument("--max-offsets", type=int, help="most messages of a micro-batch")
    parser.add_argument("--max-files", type=int, help="most files of a micro-batch")
    parser.add_argument("--checkpoint", required=True, help="folder of the stream's offsets")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--table", action="store_true", help="write the catalog table")
    target.add_argument("--cassandra", action="store_true", help="write the keyspace's table")
    target.add_argument("--directory", help="write batch directories here")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--quarantine", help="folder for messages that fail the checks")
    parser.add_argument("--quality", help="folder for quality counts of every batch")
    parser.add_argument("--continuous", action="store_true", help="keep running")
    parser.add_argument("--interval", help="pace of micro-batches, such as '1 minute'")
    parser.add_argument("--poll-interval", type=float, default=5, help="seconds between looks at the topic")
    parser.add_argument("--poll-timeout", type=float, default=360)
    parser.add_argument("--explain", action="store_true")
    return parser.parse_args(argv)


def source_of(args: argparse.Namespace) -> FileTopics | KafkaTopics:
    if args.files:
        return FileTopics(args.files, max_files_per_trigger=args.max_files)
    return KafkaTopics(
        args.servers, group_id=args.group_id, security_protocol=args.protocol,
        min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    chosen = feed(args.feed)
    spark = spark or build_session(f"{chosen.name}-{datetime.now():%Y%m%d%H%M%S}", storage_from_env())
    source = source_of(args)
    if args.table:
        sinks.create_database(spark, args.database)
        sink = sinks.CatalogTable(sinks.create_table(spark, chosen, args.database))
    elif args.cassandra:
        sink = sinks.create_keyed(spark, chosen, args.database)
    else:
        sink = sinks.BatchDirectory(args.directory)
    ready = wait_on_stream(
        lambda: source.read_stream(spark, chosen.topic), chosen, scratch_path(spark, f"ready-{chosen.name}"),
        poll_interval=args.poll_interval, poll_timeout=args.poll_timeout)
    if not ready:
        return 1
    run(ingest(
        source.read_stream(spark, chosen.topic), chosen, sink, args.checkpoint,
        quarantine=sinks.BatchDirectory(args.quarantine) if args.quarantine else None,
        quality=sinks.BatchDirectory(args.quality) if args.quality else None,
        interval=args.interval, continuous=args.continuous, explain=args.explain))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
