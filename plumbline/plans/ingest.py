"""Ingest job: event stream to minute-partitioned table, until stopped."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from plumbline.session import build_session
from plumbline.sources.streams import EVENT_TOPIC, START_POSITION, kafka_events, replay_events
from plumbline.streaming.ingest import ROWS_PER_FILE, TRIGGER_INTERVAL, block_on, start_batch_ingest, start_ingest


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers", help="read a Kafka topic")
    source.add_argument("--replay", help="read text files of payloads from this folder")
    parser.add_argument("--topic", default=EVENT_TOPIC)
    parser.add_argument("--starting-offsets", default=START_POSITION)
    parser.add_argument("--path", required=True, help="the table to append to")
    parser.add_argument("--checkpoint", required=True, help="folder for the stream's progress")
    parser.add_argument("--format", default="parquet", help="sink format, such as parquet or delta")
    parser.add_argument("--interval", default=TRIGGER_INTERVAL)
    parser.add_argument("--once", action="store_true", help="handle what is there now, then end")
    parser.add_argument("--files-per-minute", type=int, help="gather minutes before writing")
    parser.add_argument("--batches", action="store_true", help="write each batch as a version of the table, in files of ranges of minutes")
    parser.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE, help="with --batches")
    parser.add_argument("--max-offsets-per-trigger", type=int, help="most messages of a batch")
    parser.add_argument("--max-files-per-trigger", type=int, help="most files of a batch, with --replay")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session("event-ingest")
    if args.replay:
        raw = replay_events(spark, args.replay, args.max_files_per_trigger)
    else:
        raw = kafka_events(spark, args.bootstrap_servers, args.topic, args.starting_offsets, args.max_offsets_per_trigger)
    interval = None if args.once else args.interval
    if args.batches:
        block_on(start_batch_ingest(raw, args.path, args.checkpoint, interval=interval, rows_per_file=args.rows_per_file))
        return
    stream = start_ingest(
        raw,
        args.path,
        args.checkpoint,
        sink_format=args.format,
        interval=interval,
        files_per_minute=args.files_per_minute,
    )
    block_on(stream)


if __name__ == "__main__":
    main()
