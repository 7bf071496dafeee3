import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives


def brute(rows, is_anchor, positives=5, wanted=3, low=50, high=95):
    usable = [(i, y, tuple(v)) for i, y, v in rows if i is not None and y is not None and v is not None]
    anchors = {}
    for i, y, v in usable:
        if is_anchor(i):
            anchors[i] = min(anchors.get(i, (y, v)), (y, v))
    out = []
    for a, (y, v) in anchors.items():
        scores = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), i, z) for i, z, w in usable if i != a and len(w) == len(v))
        for place, (s, i, _) in enumerate([r for r in scores if r[2] == y][:positives]):
            fitting = [(n, t) for t, n, z in scores if z != y and low * -s <= 100 * -t <= high * -s][:wanted]
            out += [(a, i, at + 1, n, -s, -t, place + 1) for at, (n, t) in enumerate(fitting)]
    return sorted(out)


def mined(df, is_anchor, **more):
    return sorted(tuple(r) for r in negatives.mine(df, is_anchor, **more).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label long, vec array<long>").repartition(3)


def test_groups_ties_repeats_and_dimensions(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST", 40)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    draw = np.random.default_rng(2)
    # a hot label, frequent ones, and many rare ones that share pools
    rows = [(k, int(k % 3 and draw.integers(0, 6) + (k % 4 == 0) * draw.integers(0, 90)), draw.integers(-9, 12, 6).tolist()) for k in range(600)]
    rows += [(k, rows[k - 800][1], rows[k - 800][2]) for k in range(800, 860)]  # ties
    rows += [(7, 1, [1, 2, 3, 4, 5, 6]), (10, 0, [0] * 6), (20, 0, [9] * 6), (10, 5, [9] * 6)]  # repeated ids
    rows += [(None, 1, [9] * 6), (900, None, [9] * 6), (910, 1, None), (1000, 1, [5]), (1001, 1, [3]), (1002, 2, [2]), (1010, 1, []), (1011, 1, []), (1012, 2, [])]
    got = mined(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert len(got) > 200
    assert [r for r in got if r[0] == 1010] == [(1010, 1011, 1, 1012, 0, 0, 1)]


def test_other_numbers_and_large_components(spark):
    draw = np.random.default_rng(3)
    rows = [(k, int(k % 2), (draw.integers(-9, 12, 4) * 100_000_001).tolist()) for k in range(80)]
    got = mined(frame(spark, rows), F.col("vec_id") % 4 == 0, positives=2, negatives=6, low=10, high=120)
    assert got == brute(rows, lambda i: i % 4 == 0, 2, 6, 10, 120)


def test_scores_beyond_64_bits_fail():
    block = negatives.Block(np.array([1]), np.array([0]), np.array([[2**62, 2**62]]))
    with pytest.raises(OverflowError):
        negatives.scan(block, np.array([2**20, 2**20]), np.array([True]), lambda low, high: high >= low)


@pytest.mark.parametrize("seed", range(4))
def test_a_scan_reads_less_and_loses_nothing(seed):
    draw = np.random.default_rng(seed)
    rows, anchor = draw.integers(-80, 80, (500, 32)), draw.integers(-80, 80, 32)
    anchor[:8] *= 20  # the magnitudes decide early
    labels = draw.integers(0, 3, 500)
    block = negatives.Block(np.arange(500), labels, rows)
    exact = rows @ anchor
    found = negatives.positives_in([block], 3, 1, anchor, 5)
    want = sorted(((int(exact[i]), i) for i in range(500) if labels[i] == 1 and i != 3), key=lambda x: (-x[0], x[1]))[:5]
    assert found == [(i, s) for s, i in want]
    left = []
    negatives.scan(block, anchor, labels == 1, lambda low, high: left.append(len(low)) or high >= np.sort(low)[-5:].min())
    assert left == sorted(left, reverse=True)
    assert left[-1] < left[0] / 2


def test_rows_that_take_no_part(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.5, 0.5]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [None, 1.0])]
    rows += [(6, 2, [float("nan"), 0.5]), (8, 2, [float("-inf"), 0.5]), (None, 2, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, spans string, grp int")
    ints = negatives.integers(df, "vec_id", "embedding", F.col("label"))
    assert sorted((r.vec_id, r.vec) for r in ints.collect()) == [(0, [256, 128]), (1, [256, 64]), (2, [128, 128])]
    assert mined(ints, F.col("vec_id") % 50 == 0) == [(0, 1, 1, 2, 256 * 256 + 128 * 64, 256 * 128 + 128 * 128, 1)]
    assert mined(ints.limit(0), F.col("vec_id") % 50 == 0) == []
    assert mined(ints.where("label = 2"), F.col("vec_id") % 2 == 0) == []
