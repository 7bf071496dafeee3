import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators.ranking import index_column, number_rows, rank_categories


def words(spark, n=400):
    source = random.Random(3)
    values = ["hot" if source.random() < 0.34 else f"w{int(source.paretovariate(0.5)) % 150}" for _ in range(n)]
    return values, spark.createDataFrame([(v,) for v in values], "word string").repartition(5)


def expected(values):
    return sorted(set(values), key=lambda v: (-values.count(v), v))


@pytest.mark.parametrize("small", [0, 10**6])
def test_ranks_by_frequency_then_text(spark, small):
    values, df = words(spark)
    rows = rank_categories(df, "word", small=small).orderBy("index").collect()
    assert [r.category for r in rows] == expected(values)
    assert [r["index"] for r in rows] == list(range(len(rows)))


def test_equals_the_ml_indexer(spark):
    from plumbline.operators.features import category_indexers

    _, df = words(spark)
    model = category_indexers(["word"])[0].fit(df)
    assert model.labels == [r.category for r in rank_categories(df, "word").orderBy("index").collect()]


def test_unknown_categories_share_the_next_index(spark):
    known = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    ranks = rank_categories(known, "c")
    df = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    got = {r.c: r.i for r in index_column(df, "c", ranks, "i").collect()}
    assert got == {"a": 0.0, "b": 1.0, "new": 2.0, None: 2.0}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbering_is_dense_and_in_order(spark, parts):
    df = spark.range(500).select((F.col("id") * 7919 % 503).alias("k")).repartition(6)
    rows = number_rows(df, [F.col("k").desc()], "at", parts).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(500))
    assert [r.k for r in rows] == sorted((r.k for r in rows), reverse=True)
