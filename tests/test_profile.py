import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.tails import kolmogorov_exact_tail, kolmogorov_tail
from plumbline.operators import distribution
from plumbline.operators.profile import merged_profile, profile, sketch_rows


def distance(sides):
    n, m = sides.count(0), sides.count(1)
    i = j = 0
    worst = 0.0
    for side in sides:
        i, j = i + (side == 0), j + (side == 1)
        worst = max(worst, abs(i / n - j / m))
    return worst


@pytest.mark.parametrize(("n", "m"), [(6, 6), (3, 5), (1, 7), (4, 2)])
def test_exact_tail_counts_all_orders(n, m):
    found = [distance([0 if k in chosen else 1 for k in range(n + m)]) for chosen in itertools.combinations(range(n + m), n)]
    for d in sorted(set(round(f, 9) for f in found)):
        want = sum(f >= d - 1e-9 for f in found) / math.comb(n + m, n)
        assert kolmogorov_exact_tail(d, n, m) == pytest.approx(want, abs=1e-12)


def test_exact_and_asymptotic_tails_meet():
    assert kolmogorov_exact_tail(0.1, 400, 500) == pytest.approx(kolmogorov_tail(0.1, 400, 500), rel=0.05)
    assert kolmogorov_exact_tail(0.0, 5, 5) == 1.0 and kolmogorov_exact_tail(1.0, 30, 30) < 1e-15


def test_small_sides_are_exact_if_asked_for(spark):
    df = spark.createDataFrame([(float(k), k < 4) for k in range(9)] + [(None, True)], "x double, is_ref boolean")
    found = distribution.numeric_distances(df, ["x"])
    exact, series = (distribution.kolmogorov_smirnov(found, pairs).first().p_value for pairs in (20, 19))
    assert exact == pytest.approx(2 / math.comb(9, 4)) and series != exact


def test_distinct_values_of_any_type(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5, [1], b"x", None), (1, "", None, [1, 2], b"", None), (2, None, float("nan"), None, b"x", None)],
        "a int, `b.c` string, d double, e array<int>, f binary, g int",
    )
    rows = profile(df, distinct=True).orderBy("ordinal").collect()
    assert [(r.column, r.non_null_count, r.distinct_count) for r in rows] == [("a", 3, 2), ("b.c", 2, 2), ("d", 2, 2), ("e", 2, 2), ("f", 3, 2), ("g", 0, 0)]
    assert [r.distinct_count for r in profile(df.limit(0), distinct=True).collect()] == [0] * 6


def test_sketches_of_parts_make_the_profile_of_the_whole(spark, tmp_path):
    source = random.Random(1)
    rows = [(k % 40, f"u{source.randrange(5000)}", source.gauss(0, 1) if k % 10 else None) for k in range(20_000)]
    df = spark.createDataFrame(rows, "part int, name string, value double")
    sketch_rows(df, "part").write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    found = {r.column: r for r in merged_profile(stored).collect()}
    exact = df.agg(F.count_distinct("name")).first()[0]
    assert abs(found["name"].distinct_estimate - exact) < 0.05 * exact and found["name"].quantiles is None
    assert (found["value"].row_count, found["value"].non_null_count) == (20_000, 18_000)
    assert found["value"].quantiles == pytest.approx([-0.674, 0.0, 0.674], abs=0.06)
    some = {r.column: r for r in merged_profile(stored.where("part < 10")).collect()}
    assert some["name"].row_count == 5000 and some["name"].distinct_estimate < found["name"].distinct_estimate
