"""How well a number tells two sides apart: the rank-sum statistic with ties at their mean rank.

A row's mid-rank is the number of rows below it and half of those equal to it.  Scores are numbered along ranges: counts per distinct
score, running sums within a bucket of neighbouring scores, and the sums of all earlier buckets.  No task orders the table, and
equal scores, however many, are one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators import distribution


def rank_sums(df: DataFrame, columns: Sequence[str], flag: str, ranges: distribution.Ranges | None = None, most: int | None = None) -> DataFrame:
    """Columns ``column, wins2, n_pos, n_neg``: rows with and without the flag that have a score, and twice the pairs in which the former's is higher.

    A pair of equal scores is half won.  Scores that are NULL, NaN or infinite take no part.  Counts are exact.
    """
    if ranges is None:
        ranges = distribution.find_ranges(df, columns, flag)
    counts = distribution.value_counts(df, columns, ranges, flag, most)
    sizes = counts.groupBy("column", "bucket").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    whole = Window.partitionBy("column")
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "column", "bucket", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("c_before"), F.sum("r").over(whole).alias("n_pos"), F.sum("c").over(whole).alias("n_neg")
    )
    below = Window.partitionBy("column", "bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.join(offsets, ["column", "bucket"])
    mid2 = 2 * (F.col("c_before") + F.coalesce(F.sum("c").over(below), F.lit(0))) + F.col("c")
    won = placed.select("column", "n_pos", "n_neg", (F.col("r").cast("decimal(19,0)") * mid2.cast("decimal(19,0)")).alias("won"))
    names = F.array(*[F.lit(name) for name in columns])
    return won.groupBy("column").agg(F.sum("won").cast("decimal(38,0)").alias("wins2"), F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg")).select(
        F.get(names, F.col("column")).alias("column"), "wins2", "n_pos", "n_neg"
    )


def areas(df: DataFrame, columns: Sequence[str], flag: str, ranges: distribution.Ranges | None = None, most: int | None = None) -> DataFrame:
    """Columns ``column, auc, n_pos, n_neg``: the area under the ROC curve of each score; NULL where a side is empty."""
    pairs = 2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return rank_sums(df, columns, flag, ranges, most).select("column", F.try_divide(F.col("wins2").cast("double"), pairs).alias("auc"), "n_pos", "n_neg")


def area(df: DataFrame, column: str, flag: str) -> float | None:
    """The area of one score; ``None`` where a side is empty or no row has a score."""
    row = areas(df, [column], flag).first()
    return row.auc if row else None
