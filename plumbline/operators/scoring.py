"""Applying a model to rows and to scoring requests; batch or stream."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import features as feature_ops

# Fixed value: shape of a scoring request.
REQUEST = "dataframe_split struct<columns: array<string>, data: array<array<double>>>"


def expand_requests(
    requests: DataFrame, column: str, features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per data row of each request: ``row_no`` and the features by their names.

    Features are found by the names the request gives, in whatever order; one it does not
    give is NULL.  A request that cannot be read yields no rows.
    """
    parsed = requests.select(*keep, F.from_json(F.col(column), REQUEST)["dataframe_split"].alias("_body"))
    rows = parsed.select(
        *keep, F.col("_body.columns").alias("_names"), F.posexplode("_body.data").alias("row_no", "_row")
    )

    def cell(name: str) -> Column:
        at = F.array_position("_names", F.lit(name)).cast("int")
        return F.when(at > 0, F.get("_row", at - 1)).alias(name)

    return rows.select(*keep, "row_no", *[cell(name) for name in features])


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with their predictions; rows may be a stream."""
    return model.transform(rows)


# Why a request, or a row of one, is not scored.
UNREADABLE, NO_ROWS = "unreadable", "no_rows"
MISSING_FEATURE, REPEATED_FEATURE = "missing_feature", "repeated_feature"
WRONG_LENGTH, NO_VALUE = "wrong_length", "no_value"

# A request whose cells may be texts and numbers: cells are read as texts first.
_ANY_REQUEST = "dataframe_split struct<columns: array<string>, data: array<array<string>>>"

INPUT = "ordinal INT, name STRING, kind STRING, fill STRING, required BOOLEAN"


@dataclass(frozen=True)
class Input:
    """A column that a model takes: its Spark type, what stands in for a missing value, and whether there must be one.

    A number that is NaN or infinite counts as missing.
    """

    name: str
    kind: str = "double"
    fill: str | None = None
    required: bool = True

    @property
    def is_number(self) -> bool:
        return self.kind in ("double", "float")

    def of(self, value: Column) -> Column:
        """A value as this input's type, or NULL where it is none."""
        typed = value.try_cast(self.kind)
        if not self.is_number:
            return typed
        return F.when(~F.isnan(typed) & (F.abs(typed) < float("inf")), typed)

    def for_model(self, value: Column) -> Column:
        """The value the model sees."""
        typed = self.of(value)
        return typed if self.fill is None else F.coalesce(typed, F.lit(self.fill).cast(self.kind))

    def lacks(self, value: Column) -> Column:
        """Whether the model cannot do with this value."""
        return F.lit(False) if self.fill is not None or not self.required else self.of(value).isNull()


def input_rows(spark: SparkSession, inputs: Sequence[Input]) -> DataFrame:
    """The inputs as a table to be stored next to their model."""
    return spark.createDataFrame([(at, *astuple(one)) for at, one in enumerate(inputs)], INPUT)


def inputs_of(rows: DataFrame) -> list[Input]:
    """The inputs such a table holds."""
    return [Input(r.name, r.kind, r.fill, r.required) for r in rows.orderBy("ordinal").collect()]


def read_requests(requests: DataFrame, column: str, inputs: Sequence[Input], keep: Sequence[str] = ()) -> DataFrame:
    """One row per data row of each request, with ``row_no``, ``problem`` and the inputs; batch or stream.

    Inputs are found by the names the request gives, in whatever order; other names are passed over.  ``problem`` is NULL
    for a row that can be scored.  A request that cannot be read, has no rows, lacks an input or gives a name twice is one row without a
    number; a row of another length than the names, or without a value that the model needs, has its own.
    """
    body = F.from_json(F.col(column).cast("string"), _ANY_REQUEST)["dataframe_split"]
    parsed = requests.select(*[F.col(f"`{k}`") for k in keep], body["columns"].alias("_names"), body["data"].alias("_data"))
    given = [F.array_position("_names", F.lit(one.name)).cast("int") for one in inputs]
    missing = functools.reduce(lambda a, b: a | b, [at == 0 for at in given], F.lit(False))
    whole = (
        F.when(F.col("_names").isNull() | F.col("_data").isNull(), UNREADABLE)
        .when(F.size(F.array_distinct("_names")) < F.size("_names"), REPEATED_FEATURE)
        .when(missing, MISSING_FEATURE)
        .when(F.size("_data") == 0, NO_ROWS)
    )
    parsed = parsed.select("*", whole.alias("_whole"))
    rows = parsed.select(
        *[F.col(f"`{k}`") for k in keep], "_names", "_whole", F.posexplode_outer(F.when(F.col("_whole").isNull(), F.col("_data"))).alias("row_no", "_row")
    )
    cells = [F.when(at > 0, F.get("_row", at - 1)) for at in given]
    lacking = functools.reduce(lambda a, b: a | b, [one.lacks(cell) for one, cell in zip(inputs, cells, strict=True)], F.lit(False))
    problem = F.coalesce(
        "_whole",
        F.when(F.col("_row").isNull() | (F.size("_row") != F.size("_names")), WRONG_LENGTH).when(lacking, NO_VALUE),
    )
    values = [one.of(cell).alias(one.name) for one, cell in zip(inputs, cells, strict=True)]
    return rows.select(*[F.col(f"`{k}`") for k in keep], "row_no", problem.alias("problem"), *values)


def _free(taken: Sequence[str], name: str) -> str:
    """A column name that is not in use."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name = "_" + name
    return name


def apply_model(
    model: PipelineModel, indexes: DataFrame | None, inputs: Sequence[Input], rows: DataFrame, output: str = "prediction"
) -> DataFrame:
    """The rows as they are, with the model's prediction.

    Only the inputs go through the model, missing ones filled; whatever else the rows hold, and the inputs themselves, come
    back unchanged, whatever their names.  Categories the model has never met share one index.
    """
    if output.lower() in (c.lower() for c in rows.columns):
        raise ValueError(f"the rows have a column {output!r} already")
    packed = _free([one.name for one in inputs] + ["features", "prediction", "rawPrediction", "probability", "label"], "kept_row")
    seen = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias(packed), *[one.for_model(F.col(f"`{one.name}`")).alias(one.name) for one in inputs])
    if indexes is not None:
        columns = [r.column for r in indexes.select("column").distinct().collect()]
        seen = feature_ops.index_categories(seen, sorted(columns), indexes)
    scored = score(model, seen)
    kept = [F.col(packed).getField(c).alias(c) for c in rows.columns]
    return scored.select(*kept, F.col("prediction").alias(output))


def split_usable(rows: DataFrame, inputs: Sequence[Input]) -> tuple[DataFrame, DataFrame]:
    """Rows of a table that the model can score, and those that lack a value it needs, with the ``problem``."""
    lacking = functools.reduce(lambda a, b: a | b, [one.lacks(F.col(f"`{one.name}`")) for one in inputs], F.lit(False))
    return rows.where(~lacking), rows.where(lacking).withColumn("problem", F.lit(NO_VALUE))
