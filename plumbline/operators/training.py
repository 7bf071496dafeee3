"""Fitting and judging one classifier."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameters of a fit that nobody tuned.
DEFAULT_C = 0.5
DEFAULT_SOLVER = "liblinear"
SOLVERS = ("liblinear", "saga", "lbfgs")


@dataclass(frozen=True)
class Params:
    """``c`` is the inverse penalty; ``solver`` says how more than two classes are handled."""

    c: float = DEFAULT_C
    solver: str = DEFAULT_SOLVER


@dataclass(frozen=True)
class TrainingShape:
    """What a fit needs to know about its training rows."""

    rows: int
    classes: int


def training_shape(train: DataFrame, label: str = "label") -> TrainingShape:
    seen = train.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(label).alias("classes")
    ).first()
    return TrainingShape(seen.rows, seen.classes)


def one_against_rest(params: Params, shape: TrainingShape) -> bool:
    """Whether a fit is one of each class against the rest."""
    return params.solver == "liblinear" and shape.classes > 2


def classifier(
    params: Params,
    shape: TrainingShape,
    features: str = "features",
    label: str = "label",
    iterations: int = 100,
) -> Estimator:
    """Logistic regression whose penalty weighs as much as ``c`` says.

    A penalty of 1/(c * rows) on unscaled features is the same objective as weighting the
    summed loss by c.  With more than two classes liblinear fits one class against the rest
    and the others fit all classes jointly; with two classes all are one model.
    """
    if params.solver not in SOLVERS:
        raise ValueError(f"unknown solver {params.solver!r}")
    logistic = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        regParam=1.0 / (params.c * max(shape.rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=iterations,
    )
    if one_against_rest(params, shape):
        return OneVsRest(classifier=logistic, featuresCol=features, labelCol=label)
    return logistic


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> float | None:
    """Share of rows whose prediction is their label."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return scored.agg(F.avg(hit).alias("accuracy")).first().accuracy


@dataclass(frozen=True)
class Trained:
    run_id: str
    model: PipelineModel
    params: Params
    accuracy: float | None


def train(
    train_rows: DataFrame,
    test_rows: DataFrame,
    params: Params = Params(),
    before: PipelineModel | None = None,
    run_id: str | None = None,
) -> Trained:
    """Fit on feature rows, judge on held-out ones.

    ``before`` holds the feature stages the rows went through; the returned model includes
    them, so it can be applied to rows as they come.
    """
    fitted: Model = classifier(params, training_shape(train_rows)).fit(train_rows)
    stages = ([before] if before is not None else []) + [fitted]
    return Trained(
        run_id or uuid.uuid4().hex,
        PipelineModel(stages),
        params,
        accuracy(fitted.transform(test_rows)),
    )


def categories_path(uri: str) -> str:
    """Where the indexes of a model's categories are stored."""
    return f"{uri}-categories"


def example_path(uri: str) -> str:
    """Where an example of a model's input is stored."""
    return f"{uri}-example"


def inputs_path(uri: str) -> str:
    """Where the columns a model takes are stored."""
    return f"{uri}-inputs"


def save_model(model: PipelineModel, uri: str) -> None:
    model.write().overwrite().save(uri)


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)


def input_example(df: DataFrame, key: str, columns: list[str], n: int = 5) -> DataFrame:
    """The first rows by key, as an example of what the model takes."""
    return df.orderBy(key).select(*columns).limit(n)
