"""Two-sample measures of category columns, all from the same counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.tails import chi_square_p, normal_p
from plumbline.operators.roles import usable


def category_counts(df: DataFrame, columns: Sequence[str], flag: str = "is_ref") -> DataFrame:
    """Rows per (column, category) on either side; NULL, NaN and infinite values left out.

    Counts combine before the shuffle, so a category that fills most of the table is one row
    per task.
    """

    def category(name: str) -> Column:
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            value = usable(value)
        return value.cast("string").alias("category")

    entries = F.array(*[F.struct(F.lit(name).alias("column"), category(name)) for name in columns])
    return (
        df.select(F.col(flag).alias("_ref"), F.inline(entries))
        .where(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count_if("_ref").alias("r"), F.count_if(~F.col("_ref")).alias("c"))
    )


def _divergence(share: Column, mixed: Column) -> Column:
    return F.when(share > 0, share * F.log(share / mixed)).otherwise(0.0)


def category_measures(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance, chi-square and two-proportion z of every column.

    Side totals are one row per column, so they are broadcast to the counts.
    """
    totals = counts.groupBy("column").agg(
        F.sum("r").alias("n"),
        F.sum("c").alias("m"),
        F.min("category").alias("first_category"),
    )
    p, q = F.try_divide("r", "n"), F.try_divide("c", "m")
    mixed = (p + q) / 2
    expected = F.try_divide(F.col("r") * F.col("m"), F.col("n"))
    is_first = F.col("category") == F.col("first_category")
    summed = (
        counts.join(F.broadcast(totals), "column")
        .groupBy("column")
        .agg(
            F.max("n").alias("n_ref"),
            F.max("m").alias("n_cur"),
            F.count(F.lit(1)).alias("n_categories"),
            F.sum(_divergence(p, mixed) + _divergence(q, mixed)).alias("divergence"),
            F.sum(F.try_divide(F.pow(F.col("c") - expected, 2), expected)).alias("chi_square"),
            F.bool_or(F.col("r") == 0).alias("unseen"),
            F.max(F.when(is_first, p)).alias("p_first"),
            F.max(F.when(is_first, q)).alias("q_first"),
            F.max(F.when(is_first, F.col("r") + F.col("c"))).alias("all_first"),
        )
    )
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    n, m = F.col("n_ref"), F.col("n_cur")
    pooled = F.try_divide(F.col("all_first"), n + m)
    deviation = F.sqrt(
        pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m))
    )
    z = F.when(deviation > 0, (F.col("p_first") - F.col("q_first")) / deviation).otherwise(0.0)
    distance = F.sqrt(F.greatest(F.col("divergence"), F.lit(0.0)) / 2)
    return summed.select(
        "column",
        "n_ref",
        "n_cur",
        "n_categories",
        F.when(both, distance).alias("jensen_shannon"),
        F.when(both, F.when(F.col("unseen"), float("inf")).otherwise(F.col("chi_square"))).alias("chi_square"),
        F.when(both, z).alias("z"),
    )


def jensen_shannon(measures: DataFrame) -> DataFrame:
    """Distance with the natural logarithm: between 0 and sqrt(ln 2)."""
    return measures.select(
        "column",
        F.col("jensen_shannon").alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
        "n_ref",
        "n_cur",
    )


def chi_square(measures: DataFrame) -> DataFrame:
    """Goodness of fit of the current side to the reference shares.

    A category that the reference side never shows makes the statistic infinite and p zero.
    """
    freedom = (F.col("n_categories") - 1).cast("double")
    return measures.select(
        "column",
        F.col("chi_square").alias("statistic"),
        chi_square_p("chi_square", freedom).alias("p_value"),
        "n_ref",
        "n_cur",
    )


def proportion_z(measures: DataFrame) -> DataFrame:
    """Two-sided test that the first of two categories has one share on both sides."""
    return measures.select(
        "column",
        F.col("z").alias("statistic"),
        normal_p("z").alias("p_value"),
        "n_ref",
        "n_cur",
    )


def two_valued_or_not(measures: DataFrame) -> DataFrame:
    """The proportion test for columns of at most two categories, chi-square for the others."""
    two = F.col("n_categories") <= 2
    freedom = (F.col("n_categories") - 1).cast("double")
    return measures.select(
        "column",
        F.when(two, F.col("z")).otherwise(F.col("chi_square")).alias("statistic"),
        F.when(two, normal_p("z")).otherwise(chi_square_p("chi_square", freedom)).alias("p_value"),
        "n_ref",
        "n_cur",
    )
