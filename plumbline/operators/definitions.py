"""Suites and checkpoints as rows of an append-only log: added, updated, dropped, and rebuilt by name."""

from __future__ import annotations

import dataclasses
import datetime
import json
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.expectations import Between, ColumnExists, Expectation, InSet, NotNull, OfType
from plumbline.operators.suite import BOOLEAN_ONLY, Run, Suite, run_checkpoint
from plumbline.sources.tables import append_rows, load_table, read_log

DEFINITION = "number BIGINT, kind STRING, name STRING, body STRING, defined_at TIMESTAMP"
SUITE, CHECKPOINT = "suite", "checkpoint"
_KINDS = {check.kind: check for check in (ColumnExists, OfType, NotNull, InSet, Between)}


@dataclass(frozen=True)
class Checkpoint:
    """Tables, each with the suite it is checked against, and how much of the results to keep."""

    name: str
    validations: Sequence[tuple[str, str]]
    level: str = BOOLEAN_ONLY


def _plain(value: object) -> object:
    """A value as JSON can hold it; what JSON has no form for carries its type."""
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, datetime.datetime):
        return {"datetime": value.isoformat()}
    if isinstance(value, datetime.date):
        return {"date": value.isoformat()}
    if isinstance(value, Decimal):
        return {"decimal": str(value)}
    return value


def _typed(value: object) -> object:
    if isinstance(value, list):
        return tuple(_typed(v) for v in value)
    if isinstance(value, dict):
        ((kind, text),) = value.items()
        return {"datetime": datetime.datetime.fromisoformat, "date": datetime.date.fromisoformat, "decimal": Decimal}[kind](text)
    return value


def _check_body(check: Expectation) -> dict:
    if _KINDS.get(check.kind) is not type(check):
        raise TypeError(f"a check of type {type(check).__name__} can't be stored")
    return {"check": check.kind} | {f.name: _plain(getattr(check, f.name)) for f in dataclasses.fields(check)}


def suite_body(suite: Suite) -> str:
    return json.dumps([_check_body(check) for check in suite.expectations])


def suite_from(name: str, body: str) -> Suite:
    """The suite that was stored; fields that a stored check lacks have their defaults."""
    checks = []
    for stored in json.loads(body):
        fields = {k: _typed(v) for k, v in stored.items() if k != "check"}
        checks.append(_KINDS[stored["check"]](**fields))
    return Suite(name, tuple(checks))


class Definitions:
    """The log at one place; it has one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @property
    def log(self) -> DataFrame:
        return read_log(self.spark, self.path, DEFINITION)

    def current(self, kind: str) -> DataFrame:
        """The latest definition of each name that wasn't dropped."""
        latest = self.log.where(F.col("kind") == kind).groupBy("name").agg(F.max_by(F.struct("body", "number", "defined_at"), "number").alias("last"))
        return latest.where("last.body IS NOT NULL").select("name", "last.number", "last.body", "last.defined_at")

    def _put(self, kind: str, name: str, body: str | None, at: datetime.datetime | None) -> int:
        number = (self.log.agg(F.max("number")).first()[0] or 0) + 1
        at = at or datetime.datetime.now(datetime.timezone.utc)
        append_rows(self.spark.createDataFrame([(number, kind, name, body, at)], DEFINITION).coalesce(1), self.path)
        return number

    def add_or_update(self, defined: Suite | Checkpoint, at: datetime.datetime | None = None) -> int:
        """Store a definition; one of the same kind and name gives way to it."""
        if isinstance(defined, Suite):
            return self._put(SUITE, defined.name, suite_body(defined), at)
        body = {"validations": [list(v) for v in defined.validations], "level": defined.level}
        return self._put(CHECKPOINT, defined.name, json.dumps(body), at)

    def drop(self, kind: str, name: str, at: datetime.datetime | None = None) -> None:
        self._body(kind, name)
        self._put(kind, name, None, at)

    def _body(self, kind: str, name: str) -> str:
        row = self.current(kind).where(F.col("name") == name).first()
        if row is None:
            raise LookupError(f"no {kind} {name!r}")
        return row.body

    def suite(self, name: str) -> Suite:
        return suite_from(name, self._body(SUITE, name))

    def checkpoint(self, name: str) -> Checkpoint:
        body = json.loads(self._body(CHECKPOINT, name))
        return Checkpoint(name, tuple((table, suite) for table, suite in body["validations"]), body["level"])

    def bound(self, name: str) -> list[tuple[DataFrame, Suite]]:
        """A checkpoint's tables with their suites, as they are stored now."""
        return [(load_table(self.spark, table), self.suite(suite)) for table, suite in self.checkpoint(name).validations]

    def run(self, name: str, run: Run) -> DataFrame:
        """The results of a stored checkpoint."""
        return run_checkpoint(self.bound(name), run)
