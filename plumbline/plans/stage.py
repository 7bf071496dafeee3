"""Staging job: bronze events to the table that the checks, drift and training jobs read."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.payload import stage_events
from plumbline.session import build_session
from plumbline.sources.log import append_batch, has_versions, load_version
from plumbline.sources.tables import is_path, load_table, minutes_between


def with_key(staged: DataFrame, key: str) -> DataFrame:
    """Staged rows with a key of their content, for jobs that split by key; complete copies share it."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in staged.columns]
    return staged.withColumn(key, F.md5(F.concat_ws("\u0001", *parts)))


def stage(bronze: DataFrame, minutes: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """The staged rows of a range of minutes, both included, or of all."""
    staged = stage_events(bronze if minutes is None else minutes_between(bronze, *minutes))
    return staged if key is None else with_key(staged, key)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", required=True, help="bronze events: catalog name or path")
    parser.add_argument("--version", type=int, help="the table as it stood at this version")
    parser.add_argument("--minutes", nargs=2, metavar=("FIRST", "LAST"), help="only events of these minutes, such as 2024-01-31-23-59")
    parser.add_argument("--key", help="add a column of this name that tells rows apart")
    parser.add_argument("--output", required=True, help="folder of the staged table")
    parser.add_argument("--append", action="store_true", help="append as a version instead of writing the table anew")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session("event-staging")
    if is_path(args.table) and has_versions(spark, args.table):
        bronze = load_version(spark, args.table, args.version)
    else:
        bronze = load_table(spark, args.table, version=args.version)
    staged = stage(bronze, args.minutes, args.key)
    if args.append:
        print(f"version {append_batch(staged, args.output)}")
    else:
        staged.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
