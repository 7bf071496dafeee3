"""Batch tables: catalog names or parquet paths, versioned reads, reuse, appends."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from plumbline.session import scratch_path


def is_path(ref: str) -> bool:
    return "/" in ref


def load_table(
    spark: SparkSession,
    ref: str,
    *,
    version: int | None = None,
    versioned_format: str = "delta",
) -> DataFrame:
    """A catalog table by name or a parquet folder by path.

    ``version`` asks for an earlier version: of a folder that appends were numbered in (see ``log``), or of a
    table format that keeps versions, whose jar has to be on the classpath.  Tables without versions use :func:`as_of`.
    """
    if version is not None:
        from plumbline.sources import log

        if is_path(ref) and log.has_versions(spark, ref):
            return log.load_version(spark, ref, version)
        reader = spark.read.format(versioned_format).option("versionAsOf", version)
        return reader.load(ref) if is_path(ref) else reader.table(ref)
    return spark.read.parquet(ref) if is_path(ref) else spark.table(ref)


def as_of(log: DataFrame, column: str, bound) -> DataFrame:
    """An append-only table as it stood at ``bound``: later rows are left out at the scan."""
    return log.where(F.col(column) <= F.lit(bound))


def minutes_between(bronze: DataFrame, first: str, last: str) -> DataFrame:
    """Bronze rows of a closed range of minute keys; prunes partitions, not just rows."""
    return bronze.where(F.col("event_minute").between(first, last))


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` materialised while several passes read it, and free it on every exit."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for hundreds of passes over rows that are costly to make.

    Its partitions go by what was written, not by the input it was made from, and a task that reads them carries
    nothing of how they were made; unlike :func:`reused` it takes no memory from what the passes keep themselves.
    """
    place = scratch_path(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def append_rows(df: DataFrame, ref: str, partition_by: Sequence[str] = ()) -> None:
    """Append result rows to a parquet folder or a catalog table."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(ref):
        writer.parquet(ref)
    else:
        writer.saveAsTable(ref)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet folder, or nothing where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_log(spark: SparkSession, ref: str, schema: str, nested: bool = False) -> DataFrame:
    """An append-only log, or an empty frame of its schema where nothing was written yet.

    ``nested`` also takes files in folders below, whatever their names.
    """
    try:
        if not is_path(ref):
            return spark.table(ref)
        reader = spark.read.schema(schema)
        return (reader.option("recursiveFileLookup", "true") if nested else reader).parquet(ref)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return spark.createDataFrame([], schema)
        raise
