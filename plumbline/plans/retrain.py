"""Retraining job: search, refit with the best parameters, store, register, move the alias."""

from __future__ import annotations

import argparse
import datetime
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import features, registry, scoring, search, training
from plumbline.operators.scoring import Input
from plumbline.operators.split import train_test
from plumbline.session import build_session
from plumbline.sources.tables import load_table, reused

# The table of the event model, its columns, and the split of its rows.
DEFAULT_TABLE = "default.stg_user_events"
EVENT_LABEL = "event_type"
EVENT_CATEGORIES = ("user_id", "page")
EVENT_NUMBERS = ("purchase_value",)
TEST_SHARE, SPLIT_SEED = 0.2, 42
# What the event model takes: a missing number is 0, a missing category has the index of unknown ones.
EVENT_INPUTS = (*(Input(c, "string", required=False) for c in EVENT_CATEGORIES), *(Input(n, fill="0.0") for n in EVENT_NUMBERS))


@dataclass(frozen=True)
class Retrained:
    search_id: str
    run_id: str
    params: training.Params
    accuracy: float | None
    version: int


def event_stages() -> list:
    """Label and feature stages of the staged event table, once its categories have indexes."""
    inputs = [*(f"{c}_index" for c in EVENT_CATEGORIES), *EVENT_NUMBERS]
    return [features.label_indexer(EVENT_LABEL), features.assembler(inputs)]


def retrain(
    df: DataFrame,
    stages: list,
    key: str,
    models: registry.Registry,
    name: str,
    alias: str,
    *,
    categories: Sequence[str] = (),
    example: Sequence[str] = (),
    inputs: Sequence[Input] = (),
    n_trials: int = search.N_TRIALS,
    seed: int = SPLIT_SEED,
    parallelism: int = 4,
    at: datetime.datetime | None = None,
    search_id: str | None = None,
) -> Retrained:
    """Rows are split by key, so every trial and the refit see the same two parts.

    ``categories`` are columns that become indexes before the stages; their index table is stored next to
    the model, however many there are, and so are a few rows of the ``example`` columns and the ``inputs`` that scoring
    has to give it, which are filled here as they will be there.  Trials are written to the registry's ledger as they end; with the
    ``search_id`` of a run that was stopped, only the missing ones are fitted.
    """
    spark = df.sparkSession
    at = at or datetime.datetime.now(datetime.timezone.utc)
    run_id = uuid.uuid4().hex
    uri = f"{models.root}/models/{name}/{run_id}"
    if example:
        training.input_example(df, key, list(example)).write.parquet(training.example_path(uri))
    if inputs:
        scoring.input_rows(spark, inputs).coalesce(1).write.parquet(training.inputs_path(uri))
        df = df.withColumns({one.name: one.for_model(F.col(f"`{one.name}`")) for one in inputs})
    if categories:
        features.category_table(df, categories).write.parquet(training.categories_path(uri))
        df = features.index_categories(df, categories, spark.read.parquet(training.categories_path(uri)))
    before = features.fit_features(stages, df)
    ready = before.transform(df).select(F.col(key).alias("key"), "features", F.col("label").cast("double").alias("label"))
    train_rows, test_rows = train_test(ready, "key", TEST_SHARE, seed)
    with reused(train_rows) as fitted_on, reused(test_rows) as judged_on:
        search_id = search_id or uuid.uuid4().hex
        ledger = search.Ledger(spark, f"{models.root}/ledger")
        trials = search.continue_trials(fitted_on, judged_on, search.draw(n_trials, seed), ledger, search_id, parallelism)
        models.log_run(registry.trial_rows(trials, search_id))
        best = search.best_params(trials)
        trained = training.train(fitted_on, judged_on, best, before, run_id)
    training.save_model(trained.model, uri)
    models.log_run(
        registry.run_rows(
            spark, trained.run_id, {"C": best.c, "solver": best.solver}, {"accuracy": trained.accuracy}
        )
    )
    version = models.register(name, trained.run_id, uri, at)
    models.point(name, alias, version, at)
    return Retrained(search_id, trained.run_id, best, trained.accuracy, version)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", default=DEFAULT_TABLE, help="catalog name or path")
    parser.add_argument("--key", required=True, help="column that splits training and test rows")
    parser.add_argument("--registry", required=True, help="folder of run log, versions, aliases, models")
    parser.add_argument("--name", default="event_type_classifier")
    parser.add_argument("--alias", default="Staging")
    parser.add_argument("--text", help="train on the words of this column instead of the event columns")
    parser.add_argument("--label", help="number column that holds the class, with --text")
    parser.add_argument("--trials", type=int, default=search.N_TRIALS)
    parser.add_argument("--parallelism", type=int, default=4)
    parser.add_argument("--search-id", help="name of the search; the same name goes on with one that was stopped")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    if bool(args.text) != bool(args.label):
        raise SystemExit("--text and --label go together")
    spark = build_session("event-retrain")
    df = load_table(spark, args.table)
    if args.text:
        df = df.select(args.key, args.text, F.col(args.label).alias("label"))
        stages, categories, inputs = features.text_stages(args.text), (), (Input(args.text, "string", fill=""),)
    else:
        stages, categories, inputs = event_stages(), EVENT_CATEGORIES, EVENT_INPUTS
    made = retrain(
        df, stages, args.key, registry.Registry(spark, args.registry), args.name, args.alias,
        categories=categories, example=[one.name for one in inputs], inputs=inputs, n_trials=args.trials, parallelism=args.parallelism,
        search_id=args.search_id,
    )
    print(made)


if __name__ == "__main__":
    main()
