"""Run the lake: ``spark-submit .../jobs/votes.py --kafka HOST:PORT --jdbc-url URL --lake DIR --checkpoints DIR``.

Without a broker, ``--source-dir`` reads text files with one JSON message per line; without
a database, ``--reference-dir`` reads ``regions`` and ``provinces`` as Parquet.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from escrutinio.operators.materialize import materialize
from escrutinio.operators.reference import seats_by_province
from escrutinio.schemas import THRESHOLD
from escrutinio.session import configure_state
from escrutinio.sinks.messages import KafkaSink
from escrutinio.sources import messages, tables
from escrutinio.streaming.lake import SEATS_INTERVAL, Lake, Trigger, await_any, drain, run_lake


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Votes to seats, from messages to served tables.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--source-dir")
    reference = parser.add_mutually_exclusive_group(required=True)
    reference.add_argument("--jdbc-url")
    reference.add_argument("--reference-dir")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--lake", required=True)
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--seats-interval", default=SEATS_INTERVAL)
    parser.add_argument("--dedup-within", help="forget vote ids older than this, such as '2 days'; recommended, the state grows for ever else")
    parser.add_argument("--event-time", action="store_true", help="--dedup-within is against the votes' own times; votes out of time go to a table of their own")
    parser.add_argument("--changes-only", action="store_true", help="allocate and rewrite only provinces whose counts changed")
    parser.add_argument("--by-date", choices=["day", "month", "year"], help="keep bronze and silver in a folder per period of the votes' dates")
    parser.add_argument("--dedup-salts", type=int, default=1, help="tasks that share the copies of one id, if ids repeat very often")
    parser.add_argument("--max-offsets", type=int, default=10_000_000, help="messages of a micro-batch from Kafka")
    parser.add_argument("--max-files", type=int, default=1000, help="files of a micro-batch")
    parser.add_argument("--interval", help="how often bronze, silver and clean run; as soon as they can by default")
    parser.add_argument("--threshold", type=float, default=THRESHOLD, help="share of the votes that a party needs")
    parser.add_argument("--once", action="store_true", help="stop when the source is used up; files only")
    args = parser.parse_args(argv)
    if args.once and args.kafka:
        parser.error("--once needs --source-dir")
    if args.event_time and not args.dedup_within:
        parser.error("--event-time needs --dedup-within")
    return args


def seats_reference(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Read once at the start, and written, so that no micro-batch asks the database again."""
    if args.jdbc_url:
        options = dict(option.split("=", 1) for option in args.jdbc_option)
        model = tables.reference_from_jdbc(spark, args.jdbc_url, **options)
    else:
        model = tables.reference_from_files(spark, f"{args.reference_dir}/regions", f"{args.reference_dir}/provinces")
    return materialize(seats_by_province(*model), "seats-reference")


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = configure_state(SparkSession.builder.appName("votes").getOrCreate())
    lake = Lake(args.lake, args.checkpoints, args.by_date)
    reference = seats_reference(spark, args)
    ways = {"changes_only": args.changes_only, "event_time": args.event_time}
    if args.once:
        source = messages.file_stream(spark, args.source_dir, args.max_files)
        drain(source, lake, reference, args.max_files, args.dedup_salts, args.dedup_within, threshold=args.threshold, **ways)
        return
    clean_sink = seats_sink = None
    if args.kafka:
        source = messages.kafka_stream(spark, args.kafka, maxOffsetsPerTrigger=str(args.max_offsets))
        clean_sink = KafkaSink(args.kafka, messages.TOPIC_VOTES_CLEAN)
        seats_sink = KafkaSink(args.kafka, messages.TOPIC_VOTES_SEATS_PROVINCES)
    else:
        source = messages.file_stream(spark, args.source_dir, args.max_files)
    seats_trigger = Trigger(interval=args.seats_interval)
    layers = Trigger(interval=args.interval, max_files=args.max_files)
    sinks = clean_sink, seats_sink, seats_trigger
    await_any(run_lake(source, lake, reference, *sinks, args.dedup_salts, args.dedup_within, layers, args.threshold, **ways))


if __name__ == "__main__":
    main()
