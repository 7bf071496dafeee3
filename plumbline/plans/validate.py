"""Validation job: a table against its suite; results and a gauge are appended."""

from __future__ import annotations

import argparse
import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.definitions import Definitions
from plumbline.operators.gauges import validation_gauge
from plumbline.operators.profile import profile
from plumbline.operators.suite import (
    BOOLEAN_ONLY,
    COUNTS,
    USER_EVENTS_SUITE,
    Run,
    Suite,
    at_level,
    overall,
    run_checkpoint,
)
from plumbline.session import build_session
from plumbline.sources.tables import append_rows, load_table, reused

# Fixed value: the table the job checks unless told otherwise.
DEFAULT_TABLE = "default.stg_user_events_v2"


def validate(
    bound: Sequence[tuple[DataFrame, Suite]],
    table_name: str,
    run: Run,
    results_ref: str,
    metrics_ref: str,
    level: str = BOOLEAN_ONLY,
) -> bool:
    """Check, append the results by run date, append the gauge, and give the verdict.

    Each table is scanned once; the result rows (one per check) are kept while they are
    written and summed up.
    """
    with reused(run_checkpoint(bound, run)) as results:
        dated = at_level(results, level).withColumn("run_date", F.to_date("run_time"))
        append_rows(dated, results_ref, ["run_date"])
        verdict = overall(results)
        append_rows(validation_gauge(verdict, table_name), metrics_ref)
        return verdict.first().success


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", default=DEFAULT_TABLE, help="catalog name or path")
    parser.add_argument("--version", type=int, help="an earlier version of a versioned table")
    parser.add_argument("--results", required=True, help="where result rows are appended")
    parser.add_argument("--metrics", required=True, help="where gauge rows are appended")
    parser.add_argument("--definitions", help="folder of stored suites and checkpoints")
    parser.add_argument("--suite", help="a stored suite for the table, instead of the built-in one")
    parser.add_argument("--checkpoint", help="a stored checkpoint, which names its tables, instead of --table")
    parser.add_argument("--level", choices=[BOOLEAN_ONLY, COUNTS], default=BOOLEAN_ONLY)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    if (args.suite or args.checkpoint) and not args.definitions:
        raise SystemExit("--suite and --checkpoint need --definitions")
    spark = build_session("event-validation")
    run = Run.starting(datetime.datetime.now(datetime.timezone.utc))
    kept = Definitions(spark, args.definitions) if args.definitions else None
    if args.checkpoint:
        bound, label, level = kept.bound(args.checkpoint), args.checkpoint, kept.checkpoint(args.checkpoint).level
    else:
        df = load_table(spark, args.table, version=args.version)
        label = args.table.rsplit(".", 1)[-1] if "/" not in args.table else args.table
        bound, level = [(df, kept.suite(args.suite) if args.suite else USER_EVENTS_SUITE)], args.level
    for df, _ in bound:
        profile(df).show(truncate=False)
    success = validate(bound, label, run, args.results, args.metrics, level)
    print(f"{run.run_id}: success={success}")


if __name__ == "__main__":
    main()
