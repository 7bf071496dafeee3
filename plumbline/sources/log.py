"""Append-only tables with whole-number versions, for tables without a format that keeps them.

Every append has a number, which is the partition ``batch_id`` of its rows; when they are all written, one row in ``_commits`` says
so.  Version v is what appends up to number v have written; an append that never finished is no part of any version.  A repeated append replaces
itself, so the same number never counts twice.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.tables import append_rows, read_log
from plumbline.streaming.batches import BATCH, replace_batch

COMMIT = "batch_id BIGINT, n_rows BIGINT, committed_at TIMESTAMP"


def commits_path(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Finished appends, one row each; the last commit of a number counts."""
    latest = read_log(spark, commits_path(path), COMMIT)
    return latest.groupBy(BATCH).agg(F.max_by("n_rows", "committed_at").alias("n_rows"), F.max("committed_at").alias("committed_at"))


def append_batch(
    rows: DataFrame, path: str, batch_id: int | None = None, partition_by: Sequence[str] = (), at: datetime.datetime | None = None
) -> int:
    """Append rows under a number, by default the next one, and say which; a table has one writer at a time."""
    spark = rows.sparkSession
    if batch_id is None:
        last = commits(spark, path).agg(F.max(BATCH)).first()[0]
        batch_id = 0 if last is None else last + 1
    replace_batch(rows, path.rstrip("/"), batch_id, tuple(partition_by))
    written = spark.read.schema(rows.schema).parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}").count()
    at = at or datetime.datetime.now(datetime.timezone.utc)
    append_rows(spark.createDataFrame([(batch_id, written, at)], COMMIT).coalesce(1), commits_path(path))
    return batch_id


def _within(numbers: Sequence[int]) -> Column:
    """Whether a batch is one of these, as few ranges that prune partitions."""
    spans: list[list[int]] = []
    for number in sorted(numbers):
        if spans and number == spans[-1][1] + 1:
            spans[-1][1] = number
        else:
            spans.append([number, number])
    found = F.lit(False)
    for low, high in spans:
        found = found | F.col(BATCH).between(low, high)
    return found


def load_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at a version, by default the newest, with each row's ``batch_id``.

    Other batches' files are listed but not read.  A version that was never committed is an error.
    """
    numbers = [row[BATCH] for row in commits(spark, path).select(BATCH).collect()]  # a number per append
    if not numbers or (version is not None and version not in numbers):
        newest = f"the newest is {max(numbers)}" if numbers else "it has none"
        raise LookupError(f"{path} has no version {version}; {newest}")
    kept = [n for n in numbers if version is None or n <= version]
    return spark.read.parquet(path).where(_within(kept))


def has_versions(spark: SparkSession, path: str) -> bool:
    """Whether a folder is such a table."""
    return not read_log(spark, commits_path(path), COMMIT).isEmpty()
