import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from plumbline.operators import distribution
from plumbline.operators.ranks import area, areas, rank_sums


def brute(rows):
    pos, neg = [x for x, f in rows if f], [x for x, f in rows if not f]
    return sum((p > n) * 2 + (p == n) for p in pos for n in neg), len(pos), len(neg)


def frame(spark, rows):
    return spark.createDataFrame(rows, "x double, flag boolean").repartition(3)


@pytest.mark.parametrize("most", [None, 4])
@pytest.mark.parametrize("edges", [(), (0.0,), (-1.0, 0.25, 3.0)])
def test_pairs_are_counted_with_ties(spark, edges, most):
    source = random.Random(1)
    rows = [(source.choice([0.0, 0.0, source.gauss(0, 2), float(source.randint(0, 3))]), source.random() < 0.3) for _ in range(250)]
    row = rank_sums(frame(spark, rows), ["x"], "flag", distribution.Ranges({"x": edges}), most).first()
    assert (int(row.wins2), row.n_pos, row.n_neg) == brute(rows)


def test_area_is_that_of_the_curve(spark):
    source = random.Random(2)
    rows = [(round(source.gauss(f, 1), 1) + 0.0, bool(f)) for f in (0, 1) for _ in range(200)]
    df = frame(spark, rows)
    scored = df.select(F.col("x").alias("rawPrediction"), F.col("flag").cast("double").alias("label"))
    assert area(df, "x", "flag") == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(scored), abs=1e-12)


def test_no_pairs_no_area(spark):
    assert area(frame(spark, [(1.0, True), (2.0, True), (None, False), (float("nan"), False)]), "x", "flag") is None
    assert area(frame(spark, []), "x", "flag") is None
    assert area(frame(spark, [(1.0, True), (1.0, False)]), "x", "flag") == 0.5


def test_counts_beyond_a_long_stay_exact(spark):
    # as many pairs as a table of ten billion rows has, by weights in place of rows
    df = frame(spark, [(1.0, True), (2.0, False)])
    one = areas(df.unionByName(df).unionByName(df), ["x"], "flag").first()
    assert (one.auc, one.n_pos, one.n_neg) == (0.0, 3, 3)
    big = spark.range(1).select((F.lit(5 * 10**9).cast("decimal(19,0)") * F.lit(10**10).cast("decimal(19,0)")).alias("won"))
    assert int(big.first().won) == 5 * 10**19
