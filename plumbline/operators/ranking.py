"""Numbering rows along an order, and categories by how often they occur."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import ensure_checkpoint_dir

# Rows that one task may order by itself.
SMALL = 200_000


def number_rows(df: DataFrame, order: Sequence[Column], name: str, parts: int | None = None) -> DataFrame:
    """Position of each row in the order, from 0, without ordering the table in one task.

    The order should tell rows apart: rows that are equal in it share a range.  Rows go to
    ranges of the order, which are written out so that they stay as they are; a row's position
    is its place in its range plus the sizes of the earlier ranges.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    wanted = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(wanted, *order)
    ranged = ranged.withColumn("_range", F.spark_partition_id()).checkpoint()
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    placed = ranged.join(F.broadcast(starts), "_range")
    position = F.col("_start") + F.row_number().over(inside) - 1
    return placed.select(*df.columns, position.alias(name))


def rank_categories(df: DataFrame, column: str, small: int = SMALL) -> DataFrame:
    """Index of each category: 0 for the most frequent, ties in the order of their text.

    Columns ``category, n_rows, index``.  NULLs get none.  The categories are counted once and
    written out; up to ``small`` of them are ordered in one task, more than that in ranges.
    """
    ensure_checkpoint_dir(df.sparkSession)
    counts = (
        df.select(F.col(f"`{column}`").cast("string").alias("category"))
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .checkpoint()
    )
    order = [F.col("n_rows").desc(), F.col("category").asc()]
    if counts.count() <= small:
        return counts.withColumn("index", F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1)
    return number_rows(counts, order, "index")


def index_column(df: DataFrame, column: str, ranks: DataFrame, output: str) -> DataFrame:
    """Add a category's index as a double; a category unknown to ``ranks`` gets their number.

    The join is left to the runtime, which broadcasts the ranks when they are small and splits
    the partition of a category that holds much of the table when they are not.
    """
    known = ranks.select(F.col("category").alias("_category"), F.col("index").cast("double").alias(output))
    same = F.col(f"`{column}`").cast("string") == F.col("_category")
    unknown = F.lit(float(ranks.count()))
    joined = df.join(known, same, "left").drop("_category")
    return joined.withColumn(output, F.coalesce(F.col(output), unknown))
