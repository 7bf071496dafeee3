"""Drift job: earlier half against later half of a table; report and gauges are appended."""

from __future__ import annotations

import argparse
import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from plumbline.operators.drift import DriftRules, drift_report, drift_summary
from plumbline.operators.gauges import drift_gauges
from plumbline.operators.split import sampled, split_at_fraction, split_at_time
from plumbline.session import build_session
from plumbline.sources.tables import append_rows, load_table, reused

# The table the job measures, how its series are labelled, where it is cut.
DEFAULT_TABLE = "default.stg_user_events"
DEFAULT_LABEL = "stg_user_events_v1"
REFERENCE_SHARE = 0.5


def measure_drift(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    run_time: datetime.datetime,
    report_ref: str,
    metrics_ref: str,
    model_name: str = DEFAULT_LABEL,
    rules: DriftRules = DriftRules(),
    fraction: float = REFERENCE_SHARE,
    split_time: datetime.datetime | None = None,
) -> Row:
    """Split, compare, append report, summary and gauges; give the summary.

    With ``split_time`` the reference side is what comes before it in the first column of the order, else a share of the rows.

    Nothing is appended unless the whole report could be made.
    """
    needed = list(dict.fromkeys([*order, *columns]))
    rows = df.select(*needed)
    sides = split_at_fraction(rows, order, fraction) if split_time is None else split_at_time(rows, order[0], split_time)
    stamp = [F.lit(run_time).cast("timestamp").alias("run_time")]
    date = F.to_date("run_time").alias("run_date")
    with reused(drift_report(sides, columns, rules=rules)) as report:
        summary = drift_summary(report, rules.dataset_share)
        found = summary.first()
        append_rows(report.select(*stamp, "*").select("*", date), f"{report_ref}/columns", ["run_date"])
        append_rows(summary.select(*stamp, "*").select("*", date), f"{report_ref}/summary", ["run_date"])
        append_rows(drift_gauges(summary, model_name, run_time), metrics_ref)
        return found


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", default=DEFAULT_TABLE, help="catalog name or path")
    parser.add_argument("--order", nargs="+", default=["ts"], help="columns that order the rows")
    parser.add_argument("--columns", nargs="+", help="columns to test; all but the order's by default")
    parser.add_argument("--label", default=DEFAULT_LABEL)
    parser.add_argument("--report", required=True, help="folder the report tables are under")
    parser.add_argument("--metrics", required=True, help="where gauge rows are appended")
    parser.add_argument("--sample", type=float, help="measure a share of the table only")
    parser.add_argument("--sample-key", help="column whose values are sampled")
    parser.add_argument("--version", type=int, help="an earlier version of a versioned table")
    parser.add_argument("--split-time", type=datetime.datetime.fromisoformat, help="compare what came before this time with the rest, instead of halves")
    parser.add_argument("--exact-pairs", type=int, default=0, help="exact p-values for sides of at most so many pairs of values")
    parser.add_argument("--persist", action="store_true", help="keep the table materialised between passes")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    if args.sample is not None and not args.sample_key:
        raise SystemExit("--sample needs --sample-key")
    spark = build_session("event-drift")
    df = load_table(spark, args.table, version=args.version)
    if args.sample is not None:
        df = sampled(df, args.sample_key, args.sample)
    columns = args.columns or [c for c in df.columns if c not in args.order]
    now = datetime.datetime.now(datetime.timezone.utc)

    def run(rows: DataFrame) -> Row:
        rules = DriftRules(exact_pairs=args.exact_pairs)
        return measure_drift(rows, args.order, columns, now, args.report, args.metrics, args.label, rules, split_time=args.split_time)

    if args.persist:
        with reused(df.select(*dict.fromkeys([*args.order, *columns]))) as kept:
            print(run(kept))
    else:
        print(run(df))


if __name__ == "__main__":
    main()
