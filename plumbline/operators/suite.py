"""Suites of checks: one scan and one aggregate per table, whatever the number of checks."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.expectations import (
    Between,
    ColumnExists,
    Counters,
    Expectation,
    InSet,
    NotNull,
    OfType,
    SchemaExpectation,
    ValueExpectation,
)

BOOLEAN_ONLY = "BOOLEAN_ONLY"
COUNTS = "COUNTS"

# Fixed value: how a run is named after its start time.
RUN_NAME_FORMAT = "delta_validation_run_%Y%m%d_%H%M%S"


@dataclass(frozen=True)
class Suite:
    """Named checks in a fixed order."""

    name: str
    expectations: Sequence[Expectation] = field(default_factory=tuple)


# The checks of the staged event table.
USER_EVENTS_SUITE = Suite(
    "user_events_delta_suite",
    (
        ColumnExists("user_id"),
        NotNull("user_id"),
        ColumnExists("event_type"),
        InSet("event_type", values=("click", "page_view", "purchase", "add_to_cart")),
        ColumnExists("page"),
        InSet("page", values=("/home", "/products/1", "/products/2", "/cart", "/checkout")),
        ColumnExists("ts"),
        NotNull("ts"),
        OfType("ts", "TimestampType"),
        ColumnExists("purchase_value"),
        Between("purchase_value", mostly=0.95, low=5.0, high=100.0),
    ),
)


@dataclass(frozen=True)
class Run:
    """Identity of one validation run."""

    run_id: str
    run_time: datetime.datetime

    @classmethod
    def starting(cls, run_time: datetime.datetime) -> "Run":
        return cls(run_time.strftime(RUN_NAME_FORMAT), run_time)


def _within(tolerance: float, considered: Column, unexpected: Column) -> Column:
    share = F.try_divide(considered - unexpected, considered)
    return (considered == 0) | (share >= F.lit(tolerance))


# The errors by which a value stops an expression.
_VALUE_ERRORS = frozenset(
    "ARITHMETIC_OVERFLOW BINARY_ARITHMETIC_OVERFLOW CANNOT_PARSE_TIMESTAMP CAST_INVALID_INPUT CAST_OVERFLOW DATETIME_OVERFLOW "
    "DIVIDE_BY_ZERO INTERVAL_ARITHMETIC_OVERFLOW INTERVAL_DIVIDED_BY_ZERO INVALID_ARRAY_INDEX INVALID_ARRAY_INDEX_IN_ELEMENT_AT "
    "INVALID_FRACTION_OF_SECOND INVALID_INDEX_OF_ZERO INVALID_URL MALFORMED_RECORD_IN_PARSING NUMERIC_OUT_OF_SUPPORTED_RANGE "
    "NUMERIC_VALUE_OUT_OF_RANGE REMAINDER_BY_ZERO USER_RAISED_EXCEPTION".split()
)


def _by_a_value(error: PySparkException) -> bool:
    """Whether a query failed on a value it met, and not for want of a file, an executor or memory."""
    return (error.getCondition() or "").split(".")[0] in _VALUE_ERRORS


def _counters(df: DataFrame, suite: Suite, left_out: frozenset[int]) -> dict[int, Counters]:
    """The counters of the checks that can be evaluated, by their place in the suite."""
    return {
        ordinal: check.counters(df.schema)
        for ordinal, check in enumerate(suite.expectations)
        if isinstance(check, ValueExpectation) and ordinal not in left_out and check.evaluable(df)
    }


def _named(counters: dict[int, Counters]) -> list[Column]:
    parts = ("elements", "missing", "unexpected", "considered")
    return [F.count(F.lit(1)).alias("rows"), *[getattr(c, part).alias(f"{part}_{ordinal}") for ordinal, c in counters.items() for part in parts]]


def _fails(df: DataFrame, counters: dict[int, Counters]) -> bool:
    """Whether counting these meets a value that they can't do with; any other failure is raised."""
    try:
        df.agg(*_named(counters)).collect()
    except PySparkException as error:
        if not _by_a_value(error):
            raise
        return True
    return False


def _counted(df: DataFrame, suite: Suite) -> tuple[DataFrame, dict[int, Counters]]:
    """One row of counts, and the checks that have some.

    Without row conditions nothing can fail, and nothing is run here.  With them the counts are taken at once; only if
    that fails on a value, each condition is tried by itself, and the rest is counted without those that fail.
    """
    counters = _counters(df, suite, frozenset())
    conditioned = [o for o in counters if suite.expectations[o].row_condition is not None]
    if not conditioned:
        return df.agg(*_named(counters)), counters
    wanted = df.agg(*_named(counters))
    try:
        row = wanted.first()
    except PySparkException as error:
        if not _by_a_value(error):
            raise
        refused = frozenset(o for o in conditioned if _fails(df, {o: counters[o]}))
        counters = _counters(df, suite, refused)
        return df.agg(*_named(counters)), counters
    return df.sparkSession.createDataFrame([tuple(row)], wanted.schema), counters


def run_suite(df: DataFrame, suite: Suite, run: Run) -> DataFrame:
    """One result row per check, in suite order.

    A check that cannot be evaluated (no such column, or bounds of another type) fails and
    has no counts; it is left out of the aggregate, so it cannot stop the other checks.  A row
    condition may also fail on some row's value.  So a suite with row conditions is counted at once, and
    if that fails, each of its conditions is tried by itself, and those that fail are left out.
    """
    counted, counters = _counted(df, suite)
    rows: list[Column] = []
    for ordinal, check in enumerate(suite.expectations):
        nothing = F.lit(None).cast("bigint")
        elements, missing, unexpected = nothing, nothing, nothing
        if isinstance(check, SchemaExpectation):
            elements = F.col("rows")
            success = F.lit(check.holds(df))
        elif ordinal in counters:
            elements, missing, unexpected = (
                F.col(f"{part}_{ordinal}") for part in ("elements", "missing", "unexpected")
            )
            success = _within(check.mostly, F.col(f"considered_{ordinal}"), unexpected)
        else:
            success = F.lit(False)
        tolerance = F.lit(check.tolerance).cast("double")
        rows.append(
            F.struct(
                F.lit(ordinal).alias("ordinal"),
                F.lit(check.kind).alias("expectation"),
                F.lit(check.column).alias("column"),
                elements.alias("element_count"),
                missing.alias("missing_count"),
                unexpected.alias("unexpected_count"),
                tolerance.alias("mostly"),
                success.alias("success"),
            )
        )
    if not rows:
        rows = [F.lit(None).cast("struct<ordinal:int,expectation:string,column:string,element_count:bigint,missing_count:bigint,unexpected_count:bigint,mostly:double,success:boolean>")]
        counted = counted.where(F.lit(False))
    results = counted.select(F.inline(F.array(*rows)))
    return results.select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.run_time).cast("timestamp").alias("run_time"),
        F.lit(suite.name).alias("suite"),
        "*",
    )


def run_checkpoint(bound: Sequence[tuple[DataFrame, Suite]], run: Run) -> DataFrame:
    """The results of several (table, suite) pairs under one run; one scan per table."""
    return functools.reduce(DataFrame.unionByName, (run_suite(df, suite, run) for df, suite in bound))


def overall(results: DataFrame) -> DataFrame:
    """One row per run: did every check hold?"""
    return results.groupBy("run_id", "run_time").agg(
        F.bool_and("success").alias("success"), F.count(F.lit(1)).alias("checks")
    )


def at_level(results: DataFrame, level: str = BOOLEAN_ONLY) -> DataFrame:
    """How much of each result to keep: the verdicts only, or the counters too."""
    if level == COUNTS:
        return results
    if level == BOOLEAN_ONLY:
        return results.select(
            "run_id", "run_time", "suite", "ordinal", "expectation", "column", "success"
        )
    raise ValueError(f"unknown result level {level!r}")
