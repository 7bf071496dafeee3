"""Random search over a classifier's parameters."""

from __future__ import annotations

import datetime
import math
import random
import threading
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import OneVsRest, OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators.training import SOLVERS, Params, TrainingShape, accuracy, classifier, one_against_rest, training_shape
from plumbline.session import free_storage
from plumbline.sources.tables import append_rows, read_log, reused, stored

# Size of the search and range of the inverse penalty.
N_TRIALS = 20
LOW_C, HIGH_C = 1e-4, 1e-1


def draw(
    n: int = N_TRIALS,
    seed: int = 42,
    low: float = LOW_C,
    high: float = HIGH_C,
    solvers: Sequence[str] = SOLVERS,
) -> list[Params]:
    """Parameter sets: the inverse penalty uniform in its logarithm, the solver uniform."""
    source = random.Random(seed)
    return [
        Params(math.exp(source.uniform(math.log(low), math.log(high))), source.choice(list(solvers)))
        for _ in range(n)
    ]


def _predicted(model, rows: DataFrame, name: str) -> DataFrame:
    """Add a model's prediction and nothing else."""
    if isinstance(model, OneVsRestModel):
        before = rows.columns
        margins = []
        for at, one in enumerate(model.models):
            raw = f"{name}_{at}"
            one = one.copy().setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")
            rows = one.transform(rows)
            margins.append(vector_to_array(raw)[1])
        every = F.array(*margins)
        best = (F.array_position(every, F.array_max(every)) - 1).cast("double")
        return rows.select(*before, best.alias(name))
    model = model.copy().setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("")
    return model.transform(rows)


def _room(ready: DataFrame, shape: TrainingShape) -> int:
    """How many fits the executors can keep their rows for: each keeps its own scaled copy, 12 bytes a nonzero cell."""
    if not shape.rows:
        return 1
    cells = ready.select(Summarizer.metrics("numNonZeros").summary(F.col("features")).alias("s")).first().s.numNonZeros
    held = 12 * float(cells.toArray().sum()) + 16 * shape.rows
    return max(1, int(0.8 * free_storage(ready.sparkSession) / held))


def side_by_side(trials: Sequence[Params], shape: TrainingShape, room: int, parallelism: int) -> tuple[int, int]:
    """How many trials to fit at once, and how many classes of each that fits one class against the rest: no more fits than there is room for."""
    at_once = max(1, min(parallelism, len(trials), room))
    by_class = min(at_once, sum(one_against_rest(params, shape) for params in trials))
    spare = room - (at_once - by_class)
    return at_once, max(1, min(shape.classes, spare // by_class)) if by_class else 1


def run_trials(
    train: DataFrame, test: DataFrame, trials: Sequence[Params], parallelism: int = 4
) -> DataFrame:
    """One row per trial: parameters and held-out accuracy.

    All trials share one split.  Fits, also those of one class against the rest, run side by side over one
    stored training set, as many as memory has room for, and one scan of the test set judges all of them.
    """
    spark = train.sparkSession
    columns = ["features", "label"]
    ready = stored(train.select(*columns), "training")
    shape = training_shape(ready)
    at_once, classes_at_once = side_by_side(trials, shape, _room(ready, shape), parallelism)

    def fit(params: Params):
        one = classifier(params, shape)
        return (one.setParallelism(classes_at_once) if isinstance(one, OneVsRest) else one).fit(ready)

    with ThreadPool(at_once) as pool:
        models = pool.map(inheritable_thread_target(spark)(fit), trials)
    scored = test.select(*columns)
    for at, model in enumerate(models):
        scored = _predicted(model, scored, f"p_{at}")
    hits = scored.agg(
        *[F.avg((F.col(f"p_{at}") == F.col("label")).cast("double")).alias(f"a_{at}") for at in range(len(models))]
    ).first()
    rows = [(at, p.c, p.solver, hits[f"a_{at}"]) for at, p in enumerate(trials)]
    return spark.createDataFrame(rows, schemas.TRIAL)


def finished(ledger: DataFrame) -> DataFrame:
    """The trials of all searches; one that was finished twice counts once, as first."""
    first = ledger.groupBy("search_id", "trial_id").agg(F.min_by(F.struct("c", "solver", "accuracy"), "finished_at").alias("row"))
    return first.select("search_id", "trial_id", "row.*")


class Ledger:
    """Finished trials as an append-only table, a row each under the search's id, so that a search goes on where its driver stopped."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._one_at_a_time = threading.Lock()

    @property
    def rows(self) -> DataFrame:
        return read_log(self.spark, self.path, schemas.LEDGER)

    def trials(self, search_id: str) -> DataFrame:
        """A search's finished trials."""
        return finished(self.rows.where(F.col("search_id") == search_id)).drop("search_id")

    def add(self, search_id: str, trial_id: int, params: Params, accuracy: float | None) -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        row = self.spark.createDataFrame([(search_id, trial_id, params.c, params.solver, accuracy, now)], schemas.LEDGER)
        with self._one_at_a_time:
            append_rows(row.coalesce(1), self.path)


def continue_trials(
    train: DataFrame, test: DataFrame, trials: Sequence[Params], ledger: Ledger, search_id: str, parallelism: int = 4
) -> DataFrame:
    """One row per trial, as ``run_trials``; each is written to the ledger as soon as it is judged, and those written before aren't fitted again.

    Trials go by their place in ``trials``; a ledger whose trials have other parameters is of another search, which is an error.
    """
    spark = train.sparkSession
    columns = ["features", "label"]
    held = {r.trial_id: r for r in ledger.trials(search_id).collect()}
    for at, row in held.items():
        if at >= len(trials) or (row.c, row.solver) != (trials[at].c, trials[at].solver):
            raise ValueError(f"trial {at} of search {search_id!r} had other parameters")
    missing = [at for at in range(len(trials)) if at not in held]
    if missing:
        with reused(train.select(*columns)) as ready, reused(test.select(*columns)) as judged:
            shape = training_shape(ready)

            def run(at: int) -> None:
                model = classifier(trials[at], shape).fit(ready)
                scored = _predicted(model, judged, "prediction")
                ledger.add(search_id, at, trials[at], accuracy(scored))

            with ThreadPool(min(parallelism, len(missing))) as pool:
                pool.map(inheritable_thread_target(spark)(run), missing, chunksize=1)
    return ledger.trials(search_id)


def best_trials(ledger: DataFrame) -> DataFrame:
    """The most accurate trial of each search; the earlier of equal ones, one without an accuracy last."""
    place = F.struct(F.coalesce(-F.col("accuracy"), F.lit(float("inf"))).alias("less"), "trial_id")
    return ledger.groupBy("search_id").agg(F.min_by(F.struct("trial_id", "c", "solver", "accuracy"), place).alias("row")).select("search_id", "row.*")


def best_trial(trials: DataFrame) -> DataFrame:
    """The most accurate trial; the earlier of equal ones."""
    return trials.orderBy(F.col("accuracy").desc_nulls_last(), F.col("trial_id")).limit(1)


def best_params(trials: DataFrame) -> Params:
    row = best_trial(trials).first()
    return Params(row.c, row.solver)
