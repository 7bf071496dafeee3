"""Feature columns for classifiers."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, StringIndexer, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import ranking

def label_indexer(column: str, output: str = "label") -> StringIndexer:
    """Classes by falling frequency, ties in the order of their text."""
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType="frequencyDesc")


def category_indexers(columns: Sequence[str]) -> list[StringIndexer]:
    """Indexers that give unseen categories an index of their own, for columns of few categories.

    A fitted indexer holds its categories on the driver and in the model; ``category_table`` doesn't.
    """
    return [
        StringIndexer(
            inputCol=c, outputCol=f"{c}_index", handleInvalid="keep", stringOrderType="frequencyDesc"
        )
        for c in columns
    ]


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Indexes of the categories of several columns, as one table: ``column, category, index``."""
    ranked = [
        ranking.rank_categories(df, c).select(F.lit(c).alias("column"), "category", "index") for c in columns
    ]
    return functools.reduce(DataFrame.unionByName, ranked)


def index_categories(df: DataFrame, columns: Sequence[str], indexes: DataFrame) -> DataFrame:
    """Add ``<column>_index`` for each column, by joins with such a table; unknown and NULL categories get the next index."""
    for c in columns:
        df = ranking.index_column(df, c, indexes.where(F.col("column") == c), f"{c}_index")
    return df


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def vector_of(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """An array column as a vector column."""
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def text_stages(column: str, buckets: int = 1024, output: str = "features") -> list:
    """Term counts of a text, hashed into a fixed number of buckets."""
    return [
        Tokenizer(inputCol=column, outputCol=f"{column}_words"),
        HashingTF(inputCol=f"{column}_words", outputCol=output, numFeatures=buckets),
    ]


def fit_features(stages: list, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(df)
