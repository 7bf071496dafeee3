"""Size and shape of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_counts(df: DataFrame) -> DataFrame:
    """Columns ``ordinal, distinct_count``: exact numbers of distinct values, NULLs left out, of all columns in one scan.

    A value goes by its 128-bit digest; rows become (column, digest), which are combined before they are shuffled.
    """
    cells = F.array(*[F.struct(F.lit(at).alias("ordinal"), _digest(df, name).alias("digest")) for at, name in enumerate(df.columns)])
    seen = df.select(F.inline(cells)).where("digest IS NOT NULL").groupBy("ordinal", "digest").agg(F.count(F.lit(1)).alias("n"))
    return seen.groupBy("ordinal").agg(F.count(F.lit(1)).alias("distinct_count"))


def _digest(df: DataFrame, name: str) -> Column:
    """A digest of a value, NULL for none."""
    value, kind = df[_quoted(name)], df.schema[name].dataType
    if isinstance(kind, T.BinaryType):
        return F.md5(value)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(value.isNotNull(), F.md5(F.to_json(F.struct(value.alias("v")))))
    return F.md5(value.cast("string"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Values of a sketch: about 1.6 % (distinct) and 1.3 % (rank) of standard error.
_HLL_BITS, _KLL_SIZE = 12, 200


def sketch_rows(df: DataFrame, by: str) -> DataFrame:
    """Rows ``<by>, ordinal, column, data_type, row_count, non_null_count, distinct_sketch, quantile_sketch`` per group and column of a table.

    Sketches merge, so rows of many groups, stored once, make a profile of any of them together without the table.
    """
    names = [name for name in df.columns if name != by]
    parts = []
    for at, name in enumerate(names):
        value, kind = df[_quoted(name)], df.schema[name].dataType
        parts += [F.count(value).alias(f"n_{at}"), F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), _HLL_BITS).alias(f"d_{at}")]
        if isinstance(kind, T.NumericType):
            finite = F.when(F.abs(value.cast("double")) < float("inf"), value.cast("double"))
            parts.append(F.kll_sketch_agg_double(finite, _KLL_SIZE).alias(f"q_{at}"))
    counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), *parts)
    rows = [
        F.struct(
            F.lit(at).alias("ordinal"),
            F.lit(name).alias("column"),
            F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
            F.col("row_count").alias("row_count"),
            F.col(f"n_{at}").alias("non_null_count"),
            F.col(f"d_{at}").alias("distinct_sketch"),
            (F.col(f"q_{at}") if isinstance(df.schema[name].dataType, T.NumericType) else F.lit(None)).cast("binary").alias("quantile_sketch"),
        )
        for at, name in enumerate(names)
    ]
    return counted.select(by, F.inline(F.array(*rows)))


def merged_profile(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column from stored sketches: exact counts, about how many distinct values, and quantiles at about these ranks."""
    merged = sketches.groupBy("ordinal", "column", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("non_null_count").alias("non_null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double("quantile_sketch").alias("sketch"),
    )
    listed = F.array(*[F.lit(float(r)) for r in ranks])
    found = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", listed))
    return merged.withColumn("quantiles", found).drop("sketch")


def profile(df: DataFrame, distinct: bool = False) -> DataFrame:
    """One row per column: position, name, type, table rows, table width, non-NULL values, and exact distinct values if asked for.

    All counters but those of distinct values come from one aggregate over one scan; these take one scan and a shuffle of digests.
    """
    if distinct:
        return profile(df).join(distinct_counts(df), "ordinal", "left").fillna(0, ["distinct_count"])
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(df[_quoted(name)]).alias(f"filled_{at}") for at, name in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(at).alias("ordinal"),
            F.lit(name).alias("column"),
            F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
            F.lit(len(names)).alias("column_count"),
            F.col("row_count"),
            F.col(f"filled_{at}").alias("non_null_count"),
        )
        for at, name in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))
