"""Scoring job: resolve an alias, load its model, and apply it to rows, to requests, or to a stream of requests."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from plumbline.operators import features, scoring, training
from plumbline.operators.registry import Registry
from plumbline.operators.scoring import Input
from plumbline.session import build_session
from plumbline.sources.streams import kafka_events, replay_events
from plumbline.sources.tables import append_rows, load_table, read_if_there
from plumbline.streaming.ingest import TRIGGER_INTERVAL, block_on
from plumbline.streaming.scoring import start_scoring


@dataclass(frozen=True)
class Loaded:
    """A model, the indexes of its categories, and the columns it takes, where these are stored with it."""

    model: PipelineModel
    indexes: DataFrame | None
    inputs: list[Input] | None


def load(models: Registry, name: str, alias: str) -> Loaded:
    """The model an alias points at."""
    uri = models.uri(name, alias)
    if uri is None:
        raise LookupError(f"no model {name!r} with alias {alias!r}")
    return load_uri(models, uri)


def load_uri(models: Registry, uri: str) -> Loaded:
    indexes, inputs = (read_if_there(models.spark, path(uri)) for path in (training.categories_path, training.inputs_path))
    return Loaded(training.load_model(uri), indexes, None if inputs is None else scoring.inputs_of(inputs))


def score_rows(rows: DataFrame, models: Registry, name: str, alias: str) -> DataFrame:
    """Rows with their predictions; categories the model has never met share one index.

    A model stored with its inputs returns the rows unchanged beside the prediction; another one, all columns
    that its stages add.
    """
    loaded = load(models, name, alias)
    if loaded.inputs is not None:
        return scoring.apply_model(loaded.model, loaded.indexes, loaded.inputs, rows)
    if loaded.indexes is not None:
        columns = [r.column for r in loaded.indexes.select("column").distinct().collect()]
        rows = features.index_categories(rows, sorted(columns), loaded.indexes)
    return scoring.score(loaded.model, rows)


def score_requests(
    requests: DataFrame,
    column: str,
    inputs: Sequence[str | Input],
    keep: Sequence[str],
    models: Registry,
    name: str,
    alias: str,
) -> tuple[DataFrame, DataFrame]:
    """Predictions for the data rows of the requests, and the requests or rows that cannot be scored, each with its problem.

    ``inputs`` are asked for only where the model is not stored with its own.
    """
    loaded = load(models, name, alias)
    taken = loaded.inputs or [one if isinstance(one, Input) else Input(one) for one in inputs]
    return scored_parts(requests, column, keep, Loaded(loaded.model, loaded.indexes, taken))


def scored_parts(requests: DataFrame, column: str, keep: Sequence[str], loaded: Loaded) -> tuple[DataFrame, DataFrame]:
    rows = scoring.read_requests(requests, column, loaded.inputs, keep)
    good = scoring.apply_model(loaded.model, loaded.indexes, loaded.inputs, rows.where("problem IS NULL").drop("problem"))
    return good, rows.where("problem IS NOT NULL")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--table", help="catalog name or path of rows or requests")
    source.add_argument("--bootstrap-servers", help="read requests from a Kafka topic, as a stream")
    source.add_argument("--replay", help="read requests from text files in this folder, as a stream")
    parser.add_argument("--topic", default="scoring_requests")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--registry", required=True)
    parser.add_argument("--name", default="event_type_classifier")
    parser.add_argument("--alias", default="Staging")
    parser.add_argument("--requests", help="text column that holds requests; without it a table holds rows")
    parser.add_argument("--inputs", nargs="*", default=[], help="number columns the model takes, if it is not stored with its inputs")
    parser.add_argument("--keep", nargs="*", default=[], help="columns to keep with the predictions")
    parser.add_argument("--output", required=True, help="folder the predictions are written to")
    parser.add_argument("--rejected", help="folder for what cannot be scored; without it such rows of a table stop the job")
    parser.add_argument("--checkpoint", help="folder for a stream's progress")
    parser.add_argument("--interval", default=TRIGGER_INTERVAL)
    parser.add_argument("--once", action="store_true", help="a stream handles what is there now, then ends")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    if not args.table and not (args.checkpoint and args.rejected):
        raise SystemExit("a stream needs --checkpoint and --rejected")
    if args.requests and not args.rejected:
        raise SystemExit("--requests needs --rejected")
    spark = build_session("event-score")
    models = Registry(spark, args.registry)
    if not args.table:
        raw = replay_events(spark, args.replay) if args.replay else kafka_events(
            spark, args.bootstrap_servers, args.topic, max_offsets_per_trigger=args.max_offsets_per_trigger
        )
        loaded: dict[str, Loaded] = {}

        def parts(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
            uri = models.uri(args.name, args.alias)  # a model promoted since is used from this batch on
            if uri is None:
                raise LookupError(f"no model {args.name!r} with alias {args.alias!r}")
            if uri not in loaded:
                loaded.clear()
                loaded[uri] = load_uri(models, uri)
            model = loaded[uri]
            return scored_parts(batch, "value", args.keep, Loaded(model.model, model.indexes, model.inputs or [Input(n) for n in args.inputs]))

        block_on(start_scoring(raw, parts, args.output, args.rejected, args.checkpoint, None if args.once else args.interval))
        return
    table = load_table(spark, args.table)
    if args.requests:
        good, bad = score_requests(table, args.requests, args.inputs, args.keep, models, args.name, args.alias)
        append_rows(good, args.output)
        append_rows(bad, args.rejected)
        return
    loaded_inputs = load(models, args.name, args.alias).inputs
    if args.rejected and loaded_inputs is not None:
        table, bad = scoring.split_usable(table, loaded_inputs)
        append_rows(bad, args.rejected)
    scored = score_rows(table, models, args.name, args.alias)
    append_rows(scored.select(*(args.keep or table.columns), "prediction"), args.output)


if __name__ == "__main__":
    main()
