import math
import random

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from plumbline.catalog.base import staged_v1, table
from plumbline.catalog.drift import EVENT_COLUMNS
from plumbline.functions.tails import chi_square_tail, kolmogorov_tail, normal_two_sided_tail
from plumbline.operators import categories, distribution
from plumbline.operators.drift import DriftRules, drift_report, drift_summary
from plumbline.operators.roles import RoleRules, infer_roles, settle_distinct, table_facts
from plumbline.operators.split import split_at_fraction
from plumbline.operators.text_drift import domain_auc

NAN, INF = float("nan"), float("inf")


def sides(spark, ref, cur, kind="double"):
    rows = [(v, True) for v in ref] + [(v, False) for v in cur]
    return spark.createDataFrame(rows, f"x {kind}, is_ref boolean")


def brute(ref, cur):
    """KS and normed Wasserstein from sorted arrays."""
    ref, cur = np.sort(ref), np.sort(cur)
    points = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(ref, points, "right") / len(ref)
    g = np.searchsorted(cur, points, "right") / len(cur)
    gaps = np.abs(f - g)
    return gaps.max(), (gaps[:-1] * np.diff(points)).sum() / max(ref.std(), 0.001)


def measured(df, edges=None):
    row = distribution.numeric_distances(df, ["x"], edges={"x": edges} if edges else {}).collect()[0]
    return row.ks, row.wasserstein


def skewed(seed, n):
    source = random.Random(seed)
    # a third of the values is one value
    return [7.25 if source.random() < 0.34 else round(source.lognormvariate(2, 1), 2) for _ in range(n)]


@pytest.mark.parametrize("edges", [None, [7.25], [1.0, 5.0, 7.0, 7.25, 9.0, 500.0], [-1.0, 1e9]])
def test_distances_equal_brute_force_for_any_edges(spark, edges):
    ref, cur = skewed(1, 700), skewed(2, 1100)
    assert measured(sides(spark, ref, cur), edges) == pytest.approx(brute(ref, cur), abs=1e-12)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_distances_do_not_depend_on_partitions(spark, parts):
    ref, cur = skewed(3, 300), skewed(4, 200)
    df = sides(spark, ref, cur).repartition(parts)
    edges = distribution.find_edges(df, ["x"], count=9)
    assert len(edges["x"]) > 3
    assert measured(df, edges["x"]) == pytest.approx(brute(ref, cur), abs=1e-12)


@pytest.mark.parametrize("edges", [1, 7, 20_000])
@pytest.mark.parametrize("unique", [False, True])
def test_buckets_are_cut_until_they_fit(spark, edges, unique):
    source = random.Random(8)
    ref = [source.choice([0.0, 0.0, source.lognormvariate(0, 30), -1e100, float(k % 9)]) for k in range(900)]
    cur = [source.choice([0.0, source.lognormvariate(1, 30), 5e-324, 1e100]) for _ in range(700)]
    df = sides(spark, ref, cur)
    given = {"x": [source.uniform(-10, 10) for _ in range(edges)] if edges < 100 else [k / 100 - 100 for k in range(edges)]}
    given["x"].sort()
    ranges = distribution.Ranges(given, {"x": (0.0,)} if unique else {})
    want = pytest.approx(brute(ref, cur), rel=1e-9)
    row = distribution.numeric_distances(df, ["x"], ranges=ranges, most=5).first()
    assert (row.ks, row.wasserstein) == want
    counts = distribution.value_counts(df, ["x"], ranges, most=5)
    sizes = counts.groupBy("bucket").agg(F.count("*").alias("values"), F.sum(F.col("r") + F.col("c")).alias("rows")).collect()
    assert all(s["values"] == 1 or s["values"] <= 10 for s in sizes)
    assert counts.agg(F.sum(F.col("r") + F.col("c"))).first()[0] == 1600
    assert counts.count() == len(set(ref + cur))


def test_many_edges_of_many_columns_are_asked_for_in_seconds(spark):
    import time

    wide = spark.range(50).selectExpr("id < 25 as is_ref", *[f"cast(id * {k + 1} as double) as c{k}" for k in range(60)])
    start = time.perf_counter()
    facts = table_facts(wide, [f"c{k}" for k in range(60)], edges_per_column=8000, with_distinct=False)
    assert time.perf_counter() - start < 60
    assert all(len(f.edges) >= 49 for f in facts.columns.values())


def test_distances_are_symmetric_and_zero_on_equal_sides(spark):
    ref, cur = skewed(5, 200), skewed(6, 200)
    assert measured(sides(spark, ref, ref)) == (0.0, 0.0)
    forth, back = measured(sides(spark, ref, cur)), measured(sides(spark, cur, ref))
    assert forth[0] == pytest.approx(back[0])
    assert forth[1] * max(np.std(ref), 0.001) == pytest.approx(back[1] * max(np.std(cur), 0.001))


def test_unusable_numbers_are_left_out_per_column(spark):
    df = sides(spark, [1.0, 2.0, None, NAN, INF], [2.0, 3.0, -INF, None, NAN])
    row = distribution.numeric_distances(df, ["x"], edges={"x": [2.0]}).first()
    assert (row.n_ref, row.n_cur) == (2, 2)
    assert (row.ks, row.wasserstein) == pytest.approx(brute([1.0, 2.0], [2.0, 3.0]))


def test_one_value_one_side_and_no_rows(spark):
    assert measured(sides(spark, [3.0] * 4, [3.0] * 5)) == (0.0, 0.0)
    assert measured(sides(spark, [3.0] * 4, [4.0] * 5)) == (1.0, pytest.approx(1000.0))
    assert measured(sides(spark, [3.0] * 4, [])) == (None, None)
    empty = sides(spark, [1.0], []).where("x > 5")
    assert distribution.numeric_distances(empty, ["x"]).count() == 0


def test_pinned_distances_of_events(spark):
    pinned = {SF_SMALL: (0.044, 0.0515850663), SF_ORACLE: (0.0122, 0.0157485860)}
    for sf, expected in pinned.items():
        halves = split_at_fraction(table(spark, sf, "events"), ["ts", "event_id"])
        edges = distribution.find_edges(halves, ["value"], count=15)
        row = distribution.numeric_distances(halves, ["value"], edges=edges).first()
        assert (row.ks, row.wasserstein) == pytest.approx(expected, abs=1e-10)


def measures(spark, ref, cur):
    df = sides(spark, ref, cur, "string")
    return categories.category_measures(categories.category_counts(df, ["x"]))


def test_category_measures_by_hand(spark):
    found = measures(spark, ["a"] * 6 + ["b"] * 4, ["a"] * 3 + ["b"] * 7 + [None])
    row = found.first()
    p, q = [0.6, 0.4], [0.3, 0.7]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    js = math.sqrt(sum(a * math.log(a / c) + b * math.log(b / c) for a, b, c in zip(p, q, m)) / 2)
    assert row.jensen_shannon == pytest.approx(js)
    assert row.chi_square == pytest.approx((3 - 6) ** 2 / 6 + (7 - 4) ** 2 / 4)
    assert row.z == pytest.approx(0.3 / math.sqrt(0.45 * 0.55 * 0.2))
    p_value = categories.proportion_z(found).first().p_value
    assert p_value == pytest.approx(chi_square_tail(row.z**2, 1))


def test_unseen_category_gives_p_zero(spark):
    found = measures(spark, ["a"] * 5 + ["b"], ["a"] * 5 + ["new"])
    row = categories.chi_square(found).first()
    assert row.statistic == INF and row.p_value == 0.0
    assert 0 < found.first().jensen_shannon <= math.sqrt(math.log(2))


def test_unusable_numbers_are_no_categories(spark):
    df = sides(spark, [1.0, 2.0, NAN, None], [1.0, INF, -INF, 1.0])
    row = categories.category_measures(categories.category_counts(df, ["x"])).first()
    assert (row.n_ref, row.n_cur, row.n_categories) == (2, 2, 2)


def test_columns_without_a_test_are_left_out(spark):
    df = spark.range(50).selectExpr("id % 2 = 0 as is_ref", "map('a', id) as m", "array(id) as a", "id % 3 = 0 as b")
    assert [(r.column, r.kind) for r in drift_report(df, ["m", "a", "b"]).collect()] == [("b", "cat")]


def test_single_category_and_empty_side_are_stable(spark):
    row = categories.two_valued_or_not(measures(spark, ["a"] * 5, ["a"] * 9)).first()
    assert (row.statistic, row.p_value) == (0.0, 1.0)
    row = measures(spark, ["a"], []).first()
    assert row.jensen_shannon is None and row.chi_square is None and row.z is None
    assert measures(spark, ["a", "b"], ["c", "d"]).first().jensen_shannon == pytest.approx(math.sqrt(math.log(2)))


def test_pinned_categories_of_events(spark):
    pinned = {SF_SMALL: (0.0482766452, 8.7748708840), SF_ORACLE: (0.0084915951, 2.8994387149)}
    for sf, expected in pinned.items():
        halves = split_at_fraction(table(spark, sf, "events"), ["ts", "event_id"])
        row = categories.category_measures(categories.category_counts(halves, ["event_type"])).first()
        assert (row.jensen_shannon, row.chi_square) == pytest.approx(expected, abs=1e-9)


def test_tails_against_known_values():
    assert chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert chi_square_tail(2.0, 2) == pytest.approx(math.exp(-1))
    assert chi_square_tail(900.0, 1000) == pytest.approx(0.9893, abs=1e-3)
    assert chi_square_tail(0.0, 3) == 1.0
    assert normal_two_sided_tail(1.959963984540054) == pytest.approx(0.05, abs=1e-9)
    # Q(1.3581) = 0.05 is the classical critical value
    big = 1e12
    assert kolmogorov_tail(1.3581 / math.sqrt(big / 2), big, big) == pytest.approx(0.05, abs=1e-4)
    assert kolmogorov_tail(0.0, 50, 50) == pytest.approx(1.0)
    assert kolmogorov_tail(1.0, 500, 500) == pytest.approx(0.0, abs=1e-12)
    near = [kolmogorov_tail((1.18 + d) / math.sqrt(big / 2), big, big) for d in (-1e-9, 1e-9)]
    assert near[0] == pytest.approx(near[1], abs=1e-8)


def roles(df, columns, **rules):
    frame = df.withColumn("is_ref", F.lit(True))
    rule = RoleRules(**rules)
    return infer_roles(settle_distinct(frame, table_facts(frame, columns), rule), rule)


def test_roles(spark):
    df = spark.range(200).selectExpr(
        "cast(id % 5 as int) as five", "cast(id % 6 as int) as six", "id % 2 = 0 as flag",
        "cast(id % 100 as string) as half", "cast(id % 101 as string) as over_half",
        "cast(id as double) / 7 as x", "timestamp_seconds(id) as ts", "cast(id % 3 as double) as three",
        "array(id) as many",
    )
    found = roles(df, df.columns)
    assert found == {
        "five": "cat", "six": "num", "flag": "cat", "half": "cat", "over_half": "text", "x": "num", "three": "cat",
    }
    assert roles(df, ["ts"], include_timestamps=True) == {"ts": "num"}


def test_small_reference_uses_p_values(spark):
    halves = split_at_fraction(staged_v1(table(spark, SF_SMALL, "events")), ["ts", "event_id"])
    halves = halves.withColumn("two", F.when(F.col("event_type") == "click", "y").otherwise("n"))
    report = {r.column: r for r in drift_report(halves, [*EVENT_COLUMNS, "two"]).collect()}
    methods = {name: r.method for name, r in report.items()}
    assert methods == {
        "user_id": "chi_square", "event_type": "chi_square", "page": "chi_square",
        "purchase_value": "ks", "two": "proportion_z",
    }
    assert report["purchase_value"].statistic == pytest.approx(0.044)
    assert all(0 <= r.p_value <= 1 and r.drifted == (r.p_value < 0.05) for r in report.values())


def test_large_reference_uses_distances_and_finds_shifts(spark):
    df = spark.range(6000).selectExpr(
        "id", "id < 3000 as is_ref", "cast(id % 97 as double) as same", "cast(id as double) as moved",
        "case when id < 3000 then 'a' else 'b' end as swapped", "cast(id % 3 as string) as steady",
    )
    report = drift_report(df, ["same", "moved", "swapped", "steady"])
    verdicts = {r.column: (r.method, r.drifted) for r in report.collect()}
    assert verdicts == {
        "same": ("wasserstein", False), "moved": ("wasserstein", True),
        "swapped": ("jensen_shannon", True), "steady": ("jensen_shannon", False),
    }
    summary = drift_summary(report).first()
    assert tuple(summary) == (4, 2, 0.5, True)
    assert drift_summary(report, 0.6).first().dataset_drift is False


def test_report_of_nothing(spark):
    df = spark.sql("select timestamp'2024-01-01' as ts, true as is_ref")
    assert tuple(drift_summary(drift_report(df, ["ts"])).first()) == (0, 0, 0.0, False)


def test_text_classifier_tells_topics_apart(spark):
    def frame(current):
        words = [("alpha beta w%d" % i, True) for i in range(80)] + [(f"{current} w{i} v{i}", False) for i in range(80)]
        return spark.createDataFrame(words, "text string, is_ref boolean")

    assert domain_auc(frame("gamma delta"), "text") > 0.95
    assert domain_auc(frame("gamma").where("is_ref"), "text") is None
    report = drift_report(frame("gamma delta"), ["text"]).first()
    assert (report.kind, report.method, report.drifted) == ("text", "domain_classifier", True)
    stricter = DriftRules(auc_threshold=1.0)
    assert drift_report(frame("gamma delta"), ["text"], rules=stricter).first().drifted is False
