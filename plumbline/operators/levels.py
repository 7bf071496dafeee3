"""Columns as sequences of longs that sort alike, for finding a row of an order by counting.

A whole number, date or time is one long.  A double is one: the bits of its magnitude, negated for negative numbers.  A decimal is its
unscaled digits, eighteen to a long.  A text is its bytes, seven to a long with how many there are; a window starts where the rows that
are still tied begin to differ, so long common beginnings cost nothing.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits of a long, and bytes of a window: with three bits for their number they fit a long.
_DIGITS, _BYTES = 18, 7
# The layout of a double.
_BIAS, _FRACTION_BITS = 1023, 52
_INFINITY, _NAN = 2047 << _FRACTION_BITS, (2047 << _FRACTION_BITS) + 1


@dataclass(frozen=True)
class Level:
    """A long that sorts as a column does, or as a part of it does among rows whose earlier parts are equal."""

    position: Column
    # builds a predicate from low to high, both included; one that the scan can push down where there is one
    between: Callable[[int, int], Column]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def plain(position: Column) -> Level:
    return Level(position, lambda low, high: position.between(F.lit(low).cast("bigint"), F.lit(high).cast("bigint")))


def _whole(column: Column) -> Level:
    def between(low, high):
        return column.between(F.lit(low).cast("bigint"), F.lit(high).cast("bigint"))

    return Level(column.cast("bigint"), between)


def _instant(column: Column, kind: T.DataType) -> Level:
    def between(low, high):
        return column.between(*[F.timestamp_micros(F.lit(at).cast("bigint")).cast(kind) for at in (low, high)])

    return Level(F.unix_micros(column.cast("timestamp")), between)


def _date(column: Column) -> Level:
    return Level(F.unix_date(column).cast("bigint"), lambda low, high: column.between(*[F.date_from_unix_date(F.lit(at)) for at in (low, high)]))


def bits_of(value: Column) -> Column:
    """A double's bits as a long that sorts like it; both zeros are 0, NaN is above infinity as Spark sorts it.

    The exponent is found by logarithm and put right where rounding moved it; every other step is exact.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    guess = F.greatest(F.lit(-_BIAS + 1), F.least(F.lit(_BIAS), guess))
    two = F.lit(2.0)
    exponent = guess + F.when(size < F.pow(two, guess), -1).when((guess < _BIAS) & (size >= F.pow(two, guess + 1)), 1).otherwise(0)
    fraction = ((size / F.pow(two, exponent)) - 1) * F.lit(2.0**_FRACTION_BITS)
    normal = (exponent + _BIAS).cast("bigint") * F.lit(1 << _FRACTION_BITS).cast("bigint") + fraction.cast("bigint")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    magnitude = F.when(size < F.lit(2.0 ** (1 - _BIAS)), tiny).when(size == float("inf"), F.lit(_INFINITY)).otherwise(normal)
    return F.when(F.isnan(value), F.lit(_NAN)).when(value < 0, -magnitude).when(value.isNotNull(), magnitude)


def double_of(bits: int) -> float:
    """The double with these bits, as ``bits_of`` gives them."""
    if bits >= _NAN:
        return float("nan")
    size = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -size if bits < 0 else size


def _double(column: Column, kind: T.DataType) -> Level:
    def between(low, high):
        return column.between(*[F.lit(double_of(at)) for at in (low, high)])

    return Level(bits_of(column.cast("double")), between)


def _decimal(column: Column, kind: T.DecimalType) -> list[Level]:
    """The unscaled digits from the highest on; a negative number has all its longs negated."""
    whole, scale = kind.precision - kind.scale, kind.scale
    form = "S" + "0" * max(whole, 1) + ("." + "0" * scale if scale else "")
    written = F.to_char(column, F.lit(form))  # not by abs(), which rounds to 34 digits
    digits = F.translate(written, "+-.", "")
    sign = F.when(F.startswith(written, F.lit("-")), -1).otherwise(1).cast("bigint")
    n = max(whole, 1) + scale
    return [plain(sign * F.substring(digits, at + 1, min(_DIGITS, n - at)).cast("bigint")) for at in range(0, n, _DIGITS)]


def window_of(data: Column, offset: int) -> Column:
    """Seven bytes from ``offset`` on, and how many there are, as a long that sorts like what begins there."""
    some = F.hex(F.substring(data, offset + 1, _BYTES))
    value = F.conv(F.rpad(some, 2 * _BYTES, "0"), 16, 10).cast("bigint")
    return value * 8 + (F.length(some) / 2).cast("bigint")


def _common(a: bytes, b: bytes) -> int:
    """How many bytes two texts have in common from their beginning on."""
    for at, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return at
    return min(len(a), len(b))


def levels_of(df: DataFrame, name: str) -> Iterator[Callable[[DataFrame], Level | None]]:
    """A column's levels, each asked for with the rows that are tied in the earlier ones; ``None`` if these leave nothing to tell apart."""
    kind, column = df.schema[name].dataType, _quoted(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        if isinstance(kind, T.StringType) and kind.simpleString() != "string":
            raise TypeError(f"cannot split along {name!r} of type {kind.simpleString()}: its order isn't that of its bytes")
        data = column.cast("binary")

        def window(rows: DataFrame, first: bool) -> Level | None:
            if first:
                return plain(window_of(data, 0))
            ends = rows.agg(F.min(data).alias("low"), F.max(data).alias("high")).first()
            if ends.low == ends.high:  # also where all are NULL
                return None
            return plain(window_of(data, _common(bytes(ends.low), bytes(ends.high))))

        yield lambda rows: window(rows, True)
        while True:
            yield lambda rows: window(rows, False)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        levels = [plain(column.cast("int").cast("bigint"))] if isinstance(kind, T.BooleanType) else [_whole(column)]
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        levels = [_instant(column, kind)]
    elif isinstance(kind, T.DateType):
        levels = [_date(column)]
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        levels = [_double(column, kind)]
    elif isinstance(kind, T.DecimalType):
        levels = _decimal(column, kind)
    else:
        raise TypeError(f"cannot split along {name!r} of type {kind.simpleString()}")
    for level in levels:
        yield lambda rows, level=level: level
