"""Splitting a table in two: an exact cut along an order, and a stable split by key."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.levels import Level, levels_of, plain
from plumbline.session import ensure_checkpoint_dir

# Buckets of one counting pass: 2**16 counts and one more at most reach the driver.
_PASS_BITS = 16
# A range of at most this many rows has its values read instead of counted.
_READ_ROWS = 1 << 16


def _hash_level(df: DataFrame) -> Level:
    """A last tiebreak over whole rows, for orders that leave ties."""
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return plain(F.xxhash64(*[F.col("`" + name.replace("`", "``") + "`") for name in hashable]))


def _all_levels(df: DataFrame, order: Sequence[str]) -> Iterator[Iterator[Callable[[DataFrame], Level | None]]]:
    """The levels of each column of the order, then that of whole rows."""
    columns = [levels_of(df, name) for name in order]
    last = _hash_level(df)
    return iter([*columns, iter([lambda rows: last])])


@dataclass(frozen=True)
class _Found:
    """The value at a rank (``None`` is NULL, which sorts first) and where it stands."""

    value: int | None
    below: int
    equal: int


@dataclass(frozen=True)
class _Range:
    """Rows whose value lies from ``low`` to ``high``, and how many rows come before them."""

    low: int
    high: int
    below: int
    size: int


def _bounds(df: DataFrame, level: Level) -> tuple[int, int, _Range]:
    """Rows, rows without a value, and the range of all others."""
    seen = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(level.position).alias("filled"),
        F.min(level.position).alias("low"),
        F.max(level.position).alias("high"),
    ).first()
    nulls = seen.n - seen.filled
    return seen.n, nulls, _Range(seen.low, seen.high, nulls, seen.filled)


def _narrow(df: DataFrame, level: Level, rank: int, around: _Range) -> _Range:
    """One counting pass: the bucket of ``around`` that holds the row at ``rank``."""
    shift = max(0, (around.high - around.low).bit_length() - _PASS_BITS)
    counted = (
        df.where(level.between(around.low, around.high))
        .groupBy(F.shiftright(level.position, shift).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()
        .sort_by("bucket")
    )
    upto = around.below + np.cumsum(counted["n"].to_numpy())
    at = int(np.searchsorted(upto, rank))
    bucket, size = counted["bucket"][at].as_py(), counted["n"][at].as_py()
    return _Range(
        max(around.low, bucket << shift),
        min(around.high, ((bucket + 1) << shift) - 1),
        int(upto[at]) - size,
        size,
    )


def _value_at(df: DataFrame, level: Level, rank: int, bounds=None) -> _Found:
    """The ``rank``-th smallest value (from 1): count ever narrower ranges, then read a small one."""
    _, nulls, around = bounds or _bounds(df, level)
    if rank <= nulls:
        return _Found(None, 0, nulls)
    while around.low < around.high and around.size > _READ_ROWS:
        around = _narrow(df, level, rank, around)
    if around.low == around.high:
        return _Found(around.low, around.below, around.size)
    values = np.sort(
        df.where(level.between(around.low, around.high))
        .select(level.position.alias("at"))
        .toArrow()["at"]
        .to_numpy()
    )
    value = int(values[rank - around.below - 1])
    first, last = np.searchsorted(values, value, "left"), np.searchsorted(values, value, "right")
    return _Found(value, around.below + int(first), int(last - first))


def _is(level: Level, found: _Found) -> Column:
    if found.value is None:
        return level.position.isNull()
    return F.coalesce(level.between(found.value, found.value), F.lit(False))


def _before(level: Level, found: _Found) -> Column:
    if found.value is None:
        return F.lit(False)
    return level.position.isNull() | (level.position < F.lit(found.value))


def split_at_fraction(
    df: DataFrame, order: Sequence[str], fraction: float = 0.5, flag: str = "is_ref"
) -> DataFrame:
    """Mark the first ``floor(n * fraction)`` rows of the order with ``flag``.

    The row at the cut is found by counting: each pass is a scan with at most 65,537 counts as
    its result, and later passes only read the range that still matters.  The rows themselves
    are neither sorted nor shuffled: the result is ``df`` plus one comparison.  Columns are numbers,
    dates, times, texts, bytes or booleans, in Spark's order; NULLs sort first.  Ties in the order are broken by a hash of the whole row; rows that are equal even
    then are copies, of which the right number is marked.
    """
    columns = [list(itertools.islice(levels, 1)) + [levels] for levels in _all_levels(df, order)]
    bounds = _bounds(df, columns[0][0](df))
    count = bounds[0]
    rank = math.floor(count * fraction)
    if rank <= 0:
        return df.withColumn(flag, F.lit(False))
    if rank >= count:
        return df.withColumn(flag, F.lit(True))

    marked = F.lit(False)
    tied = F.lit(True)
    rows, wanted = df, rank
    for first, further in columns:
        for ask in itertools.chain([first], further):
            level = ask(rows)
            if level is None:
                break
            found = _value_at(rows, level, wanted, bounds)
            bounds = None
            marked = marked | (tied & _before(level, found))
            here = _is(level, found)
            tied = tied & here
            wanted -= found.below
            if wanted == found.equal:
                return df.withColumn(flag, marked | tied)
            rows = rows.where(here)
    return _split_copies(df, flag, marked, tied, wanted)


def _split_copies(
    df: DataFrame, flag: str, marked: Column, tied: Column, wanted: int
) -> DataFrame:
    """The cut runs through copies of one row: number them in place and mark ``wanted`` of them.

    Copies are numbered by partition and place in it, and written out so that the numbers stay
    as they are however often the result is read.
    """
    ensure_checkpoint_dir(df.sparkSession)
    copies = df.where(tied).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33)
    sizes = copies.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    last = None
    for row in sorted(sizes, key=lambda r: r.part):
        if wanted <= row.n:
            last = (row.part << 33) + wanted
            break
        wanted -= row.n
    numbered = copies.withColumn(flag, F.col("_at") < F.lit(last)).drop("_at")
    return df.where(~tied).withColumn(flag, marked).unionByName(numbered)


def split_at_time(df: DataFrame, column: str, cut, flag: str = "is_ref") -> DataFrame:
    """Mark the rows before a given moment; rows without a time belong to the earlier side."""
    return df.withColumn(flag, F.coalesce(F.col(column) < F.lit(cut), F.lit(True)))


def side_sizes(df: DataFrame, flag: str = "is_ref") -> DataFrame:
    """Rows in all, on the reference side and on the current side."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(flag)).alias("n_ref"),
        F.count_if(~F.col(flag)).alias("n_cur"),
    )


# Hex digits of a digest that a share is compared with, as a number: fine enough for shares of 1e-15.
SHARE_DIGITS = 15


def share_bound(share: float) -> int:
    """Digests below this number belong to the share."""
    if not 0 <= share <= 1:
        raise ValueError(f"a share lies between 0 and 1, not {share!r}")
    return int(share * 16**SHARE_DIGITS)


def in_share(key: Column, share: float, seed: int = 42) -> Column:
    """Whether a key falls into a fixed share of all keys: none for 0, all for 1.

    Depends on key and seed only: not on partitions, file order or the other rows.
    """
    bound = share_bound(share)
    if share in (0, 1):
        return F.lit(share == 1)
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, SHARE_DIGITS), 16, 10).cast("bigint") < F.lit(bound).cast("bigint")


def train_test(
    df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training rows and test rows, by key."""
    test = in_share(F.col(key), test_share, seed)
    return df.where(~test), df.where(test)


def sampled(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """A repeatable sample of keys, for callers that want a cheaper look at a large table."""
    return df.where(in_share(F.col(key), share, seed))
