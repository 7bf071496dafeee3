"""What the corpus operators share: columns, whole tables, written tables."""

from __future__ import annotations

import re

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import ensure_checkpoint_dir, scratch_path

# The bytes that part words, as a class of a regular expression.
SPACE = r"\x20\x09-\x0D"


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with nulls as empty texts."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def packed(docs: DataFrame) -> list[Column]:
    """A row's columns, whatever their names, under names by their place; ``unpacked`` gives them back.

    An operator that has no names of this kind itself can't meet a user's.
    """
    return [quoted(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]


def place(docs: DataFrame, name: str) -> str:
    """Under which name ``packed`` carries a column."""
    return f"c{docs.columns.index(name)}"


def unpacked(docs: DataFrame, new: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``docs`` that ``packed`` carried, with those in ``new`` in place of their own."""
    return [(new or {}).get(c, F.col(f"c{k}")).alias(c) for k, c in enumerate(docs.columns)]


def content(docs: DataFrame) -> Column:
    """What tells rows apart, as a value to be hashed: all columns but maps, and which of them are null, as nulls count for nothing in a hash."""
    own = [quoted(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.struct(*[F.struct(c.isNull().alias("none"), c.alias("own")) for c in own])


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage and survives lost executors.

    Unlike ``checkpoint()`` it forgets how rows are dealt out, so that a later join may be
    dealt anew, and split where one key holds much of the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint, which Spark's cleaner removes when nothing refers to it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a URI names, and the path in it; Hadoop's names of a scheme mean the same store."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
