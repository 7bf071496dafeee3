"""Row conditions as text: comparisons of columns with values, joined by and, or, not.

    col("event_type") == "purchase" and not (col("value") > 100 or col("page").isNull())

Operators are == != < <= > >= (also in chains), ``in`` with a list, ``and`` ``or`` ``not`` or ``&`` ``|`` ``~``, and
``.isNull()``, ``.notNull()``, ``.isNotNull()``.  Values are quoted texts, numbers, True and False; NULL compares as SQL's.
Nothing else is understood, and nothing is executed: the text is read as an expression and turned into a column.
"""

from __future__ import annotations

import ast
import datetime
import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMPARE: dict[type, Callable] = {
    ast.Eq: operator.eq,
    ast.NotEq: operator.ne,
    ast.Lt: operator.lt,
    ast.LtE: operator.le,
    ast.Gt: operator.gt,
    ast.GtE: operator.ge,
}
_TESTS = {"isNull": Column.isNull, "notNull": Column.isNotNull, "isNotNull": Column.isNotNull}


class ConditionError(ValueError):
    """A text that is no row condition, or not one for these columns."""


def _value_type(value: object) -> str:
    return "boolean" if isinstance(value, bool) else "number" if isinstance(value, (int, float)) else "text"


def _column_type(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "date" if isinstance(kind, T.DateType) else "text" if isinstance(kind, T.StringType) else kind.simpleString()


class _Reader:
    """Turns the parts of an expression into columns over a schema."""

    def __init__(self, schema: T.StructType):
        self.types = {f.name: f.dataType for f in schema.fields}

    def column(self, node: ast.expr) -> tuple[Column, str] | None:
        """``col("name")``, if this is one, and what it can be compared with."""
        if not (isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "col"):
            return None
        if len(node.args) != 1 or node.keywords or not isinstance(node.args[0], ast.Constant) or not isinstance(node.args[0].value, str):
            raise ConditionError("col() takes one quoted name")
        name = node.args[0].value
        if name not in self.types:
            raise ConditionError(f"no column {name!r}")
        return F.col("`" + name.replace("`", "``") + "`"), _column_type(self.types[name])

    def value(self, node: ast.expr) -> object:
        sign = 1
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            node, sign = node.operand, -1
        if not isinstance(node, ast.Constant) or not isinstance(node.value, (str, int, float, bool)):
            raise ConditionError(f"not a value: {ast.unparse(node)}")
        if sign < 0 and _value_type(node.value) != "number":
            raise ConditionError(f"not a number: {ast.unparse(node)}")
        return node.value if sign > 0 else -node.value

    def literal(self, value: object, against: str) -> Column:
        """A value that may be compared with a column of this type."""
        own = _value_type(value)
        if against in ("date", "time") and own == "text":
            try:
                parsed = datetime.datetime.fromisoformat(value)
            except ValueError as error:
                raise ConditionError(f"not a {against}: {value!r}") from error
            return F.lit(parsed.date() if against == "date" else parsed)
        if own != against:
            raise ConditionError(f"a {against} is not compared with {value!r}")
        return F.lit(value)

    def compared(self, left: ast.expr, op: ast.cmpop, right: ast.expr) -> Column:
        a, b = self.column(left), self.column(right)
        if isinstance(op, ast.In) and a and isinstance(right, (ast.List, ast.Tuple)):
            return a[0].isin([self.literal(self.value(v), a[1]) for v in right.elts])
        if type(op) not in _COMPARE:
            raise ConditionError("not a comparison that is known here")
        if a and b:
            if a[1] != b[1]:
                raise ConditionError(f"a {a[1]} is not compared with a {b[1]}")
            return _COMPARE[type(op)](a[0], b[0])
        if a:
            return _COMPARE[type(op)](a[0], self.literal(self.value(right), a[1]))
        if b:
            return _COMPARE[type(op)](self.literal(self.value(left), b[1]), b[0])
        raise ConditionError("a comparison needs a column")

    def condition(self, node: ast.expr) -> Column:
        if isinstance(node, ast.BoolOp):
            join = operator.and_ if isinstance(node.op, ast.And) else operator.or_
            return functools.reduce(join, [self.condition(part) for part in node.values])
        if isinstance(node, ast.BinOp) and isinstance(node.op, (ast.BitAnd, ast.BitOr)):
            join = operator.and_ if isinstance(node.op, ast.BitAnd) else operator.or_
            return join(self.condition(node.left), self.condition(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.Not, ast.Invert)):
            return ~self.condition(node.operand)
        if isinstance(node, ast.Compare):
            places = [node.left, *node.comparators]
            return functools.reduce(operator.and_, [self.compared(a, op, b) for a, op, b in zip(places, node.ops, places[1:], strict=False)])
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in _TESTS and not node.args and not node.keywords:
            held = self.column(node.func.value)
            if held:
                return _TESTS[node.func.attr](held[0])
        held = self.column(node)
        if held and held[1] == "boolean":
            return held[0]
        raise ConditionError(f"not a condition: {ast.unparse(node)}")


def parse(text: str, schema: T.StructType) -> Column:
    """The condition as a boolean column over rows of this schema; ``ConditionError`` if it is none."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except (SyntaxError, ValueError, RecursionError, MemoryError) as error:
        raise ConditionError(f"not a condition: {text!r}") from error
    try:
        return _Reader(schema).condition(tree.body)
    except RecursionError as error:
        raise ConditionError("a condition nested too deeply") from error
