"""Declarative column checks; each turns into counters of one shared aggregate.

Counting rules: rows that do not meet a check's row condition are no elements of it.  NULLs
are missing, and only ``NotNull`` counts them against the check.  A check holds when at least
``mostly`` of the considered values are as expected, or when there is nothing to consider.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from plumbline.operators.conditions import ConditionError, parse

SQL_CONDITION, COL_CONDITION = "sql", "col"


@dataclass(frozen=True, kw_only=True)
class Counters:
    """The aggregates one check needs."""

    elements: Column
    missing: Column
    unexpected: Column
    considered: Column


@dataclass(frozen=True)
class Expectation:
    """A check of one column."""

    column: str

    @property
    def kind(self) -> str:
        raise NotImplementedError

    @property
    def tolerance(self) -> float | None:
        return None

    def field(self, df: DataFrame) -> T.StructField | None:
        return next((f for f in df.schema.fields if f.name == self.column), None)


@dataclass(frozen=True)
class SchemaExpectation(Expectation):
    """Answered from the schema alone."""

    def holds(self, df: DataFrame) -> bool:
        raise NotImplementedError


@dataclass(frozen=True)
class ColumnExists(SchemaExpectation):
    kind = "column_exists"

    def holds(self, df: DataFrame) -> bool:
        return self.field(df) is not None


@dataclass(frozen=True)
class OfType(SchemaExpectation):
    """``type_name`` is the name of a Spark type, such as ``TimestampType``."""

    type_name: str
    kind = "of_type"

    def holds(self, df: DataFrame) -> bool:
        field = self.field(df)
        return field is not None and type(field.dataType).__name__ == self.type_name


@dataclass(frozen=True)
class ValueExpectation(Expectation):
    """Answered by counting values."""

    mostly: float = 1.0
    row_condition: str | None = None
    # "sql", or "col" for conditions such as col("event_type") == "purchase"
    condition_language: str = SQL_CONDITION

    @property
    def tolerance(self) -> float:
        return self.mostly

    @property
    def value(self) -> Column:
        return F.col("`" + self.column.replace("`", "``") + "`")

    def accepts(self, data_type: T.DataType) -> bool:
        """Whether the check means anything for values of this type."""
        return True

    def violated(self) -> Column:
        """True for a non-NULL value that is not as expected."""
        raise NotImplementedError

    def evaluable(self, df: DataFrame) -> bool:
        field = self.field(df)
        if field is None or not self.accepts(field.dataType):
            return False
        if self.row_condition is None:
            return True
        try:
            condition = self.condition(df.schema)
            counters = self.counters(df.schema)
            df.agg(counters.elements, counters.missing, counters.unexpected).schema  # noqa: B018
            return isinstance(df.select(condition).schema[0].dataType, T.BooleanType)
        except (AnalysisException, ConditionError):
            return False

    def condition(self, schema: T.StructType) -> Column:
        """Which rows of this schema are elements of the check."""
        if self.row_condition is None:
            return F.lit(True)
        if self.condition_language == COL_CONDITION:
            return parse(self.row_condition, schema)
        if self.condition_language == SQL_CONDITION:
            return F.expr(self.row_condition)
        raise ConditionError(f"unknown condition language {self.condition_language!r}")

    def _count(self, of: Column, schema: T.StructType) -> Column:
        if self.row_condition is None:
            return F.count_if(of)
        return F.count_if(self.condition(schema) & of)

    def counters(self, schema: T.StructType) -> Counters:
        elements = self._count(F.lit(True), schema)
        missing = self._count(self.value.isNull(), schema)
        unexpected = self._count(self.value.isNotNull() & self.violated(), schema)
        return Counters(
            elements=elements,
            missing=missing,
            unexpected=unexpected,
            considered=elements - missing,
        )


@dataclass(frozen=True)
class NotNull(ValueExpectation):
    kind = "not_null"

    def violated(self) -> Column:
        return self.value.isNull()

    def counters(self, schema: T.StructType) -> Counters:
        elements = self._count(F.lit(True), schema)
        missing = self._count(self.value.isNull(), schema)
        return Counters(
            elements=elements, missing=missing, unexpected=missing, considered=elements
        )


_FAMILIES = (
    (T.StringType, str),
    (T.BooleanType, bool),
    (T.NumericType, (int, float, Decimal)),
    ((T.TimestampType, T.TimestampNTZType), datetime.datetime),
    (T.DateType, datetime.date),
)


def _comparable(data_type: T.DataType, literal) -> bool:
    """Comparing across families would need a cast that can fail at run time."""
    for spark_types, python_types in _FAMILIES:
        if isinstance(data_type, spark_types):
            if isinstance(literal, bool) and python_types is not bool:
                return False
            return isinstance(literal, python_types)
    return False


@dataclass(frozen=True)
class InSet(ValueExpectation):
    values: Sequence = ()
    kind = "in_set"

    def accepts(self, data_type: T.DataType) -> bool:
        return all(_comparable(data_type, value) for value in self.values)

    def violated(self) -> Column:
        return ~self.value.isin(list(self.values)) if self.values else F.lit(True)


@dataclass(frozen=True)
class Between(ValueExpectation):
    """Both bounds belong to the range; either may be left open.  NaN lies outside."""

    low: object = None
    high: object = None
    kind = "between"

    def accepts(self, data_type: T.DataType) -> bool:
        return all(
            _comparable(data_type, bound) for bound in (self.low, self.high) if bound is not None
        )

    def violated(self) -> Column:
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (self.value < F.lit(self.low))
        if self.high is not None:
            outside = outside | (self.value > F.lit(self.high))
        numbers = (int, float, Decimal)
        if any(isinstance(b, numbers) and not isinstance(b, bool) for b in (self.low, self.high)):
            # by the column's values, whatever the kind of number of the bounds
            outside = outside | F.isnan(self.value.cast("double"))
        return outside
