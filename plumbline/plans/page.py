"""Page job: the latest gauges of a metric table as text that a scraper reads."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from plumbline import schemas
from plumbline.operators.gauges import exposition, latest_push, write_page
from plumbline.session import build_session
from plumbline.sources.tables import read_log


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--metrics", required=True, help="where the jobs append their gauge rows")
    parser.add_argument("--page", required=True, help="folder the page is written to, in place of the last one")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session("event-page")
    write_page(exposition(latest_push(read_log(spark, args.metrics, schemas.METRIC))), args.page)


if __name__ == "__main__":
    main()
