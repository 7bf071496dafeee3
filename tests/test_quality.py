import datetime

import pytest
from conftest import SF_ORACLE

from plumbline.catalog.base import staged_v2, table
from plumbline.operators.expectations import Between, ColumnExists, InSet, NotNull, OfType
from plumbline.operators.profile import profile
from plumbline.operators.suite import (
    USER_EVENTS_SUITE,
    Run,
    Suite,
    at_level,
    overall,
    run_checkpoint,
    run_suite,
)

RUN = Run.starting(datetime.datetime(2024, 5, 6, 7, 8, 9))
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("a", 5.0), ("a", 100.0), ("b", 4.99), (None, 100.01), ("c", None), ("c", NAN), ("a", INF), ("a", -INF)]
    return spark.createDataFrame(rows, "kind string, x double")


def outcome(df, *checks):
    rows = run_suite(df, Suite("s", checks), RUN).orderBy("ordinal").collect()
    return [(r.element_count, r.missing_count, r.unexpected_count, r.success) for r in rows]


def test_not_null_counts_nulls_against_all_rows(frame):
    assert outcome(frame, NotNull("kind"), NotNull("kind", mostly=0.8)) == [(8, 1, 1, False), (8, 1, 1, True)]


def test_range_is_closed_and_nan_and_infinity_lie_outside(frame):
    assert outcome(frame, Between("x", low=5.0, high=100.0)) == [(8, 1, 5, False)]
    assert outcome(frame, Between("x", low=5.0)) == [(8, 1, 3, False)]


def test_tolerance_leaves_nulls_out_of_the_denominator(frame):
    # 2 of 7 values are inside
    within = 2 / 7
    got = outcome(frame, Between("x", mostly=within, low=5.0, high=100.0), Between("x", mostly=0.29, low=5.0, high=100.0))
    assert [g[3] for g in got] == [True, False]


def test_set_ignores_nulls(frame):
    assert outcome(frame, InSet("kind", values=("a", "b", "c")), InSet("kind", values=("a",))) == [
        (8, 1, 0, True),
        (8, 1, 3, False),
    ]


def test_no_value_to_consider_is_success(spark):
    empty = spark.createDataFrame([], "x double")
    assert outcome(empty, Between("x", low=0.0), NotNull("x")) == [(0, 0, 0, True), (0, 0, 0, True)]
    nulls = spark.createDataFrame([(None,)], "x double")
    assert outcome(nulls, Between("x", low=0.0), NotNull("x")) == [(1, 1, 0, True), (1, 1, 1, False)]


def test_row_condition_restricts_elements(frame):
    check = Between("x", low=5.0, high=100.0, row_condition="kind = 'a' and x < 1000")
    assert outcome(frame, check) == [(3, 0, 1, False)]


def test_checks_that_cannot_be_evaluated_fail_alone(frame):
    got = outcome(
        frame,
        NotNull("missing"),
        Between("kind", low=1.0, high=2.0),
        InSet("x", values=("a",)),
        NotNull("x", row_condition="missing > 1"),
        NotNull("x", row_condition="x + 1"),
        OfType("missing", "DoubleType"),
        NotNull("x", mostly=0.5),
    )
    assert got[:5] == [(None, None, None, False)] * 5
    assert got[5][3] is False
    assert got[6] == (8, 1, 1, True)


def test_schema_checks(spark, frame):
    assert [g[3] for g in outcome(frame, ColumnExists("x"), ColumnExists("y"), OfType("x", "DoubleType"))] == [
        True, False, True,
    ]
    zoneless = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as ts")
    assert [g[3] for g in outcome(zoneless, OfType("ts", "TimestampType"), OfType("ts", "TimestampNTZType"))] == [
        False, True,
    ]


def test_empty_suite_has_no_results(frame):
    assert run_suite(frame, Suite("none"), RUN).count() == 0


def test_column_names_with_dots_and_marks(spark):
    odd = spark.createDataFrame([(1.0, None)], "`a.b` double, `c``d` double")
    assert outcome(odd, Between("a.b", low=0.0), NotNull("c`d")) == [(1, 0, 0, True), (1, 1, 1, False)]


def test_one_scan_per_suite(spark):
    staged = staged_v2(table(spark, SF_ORACLE, "events"))
    plan = run_suite(staged, USER_EVENTS_SUITE, RUN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_pinned_values_of_the_event_suite(spark):
    staged = staged_v2(table(spark, SF_ORACLE, "events"))
    rows = {(r.expectation, r.column): r for r in run_suite(staged, USER_EVENTS_SUITE, RUN).collect()}
    value = rows["between", "purchase_value"]
    assert (value.element_count - value.missing_count, value.unexpected_count, value.success) == (1981, 423, False)
    kind = rows["in_set", "event_type"]
    assert (kind.element_count, kind.unexpected_count, kind.success) == (10000, 4031, False)
    assert rows["of_type", "ts"].success


def test_run_identity_levels_and_conjunction(frame):
    assert RUN.run_id == "delta_validation_run_20240506_070809"
    good, bad = Suite("good", (ColumnExists("x"),)), Suite("bad", (ColumnExists("y"), ColumnExists("x")))
    results = run_checkpoint([(frame, good), (frame, bad)], RUN)
    assert overall(results).collect()[0].success is False
    assert overall(run_checkpoint([(frame, good)], RUN)).collect()[0].success is True
    assert "unexpected_count" not in at_level(results).columns
    assert "unexpected_count" in at_level(results, "COUNTS").columns
    with pytest.raises(ValueError):
        at_level(results, "everything")


def test_profile(frame):
    rows = profile(frame).orderBy("ordinal").collect()
    assert [(r.column, r.data_type, r.row_count, r.non_null_count) for r in rows] == [
        ("kind", "string", 8, 7), ("x", "double", 8, 7),
    ]


def test_a_row_condition_that_fails_on_a_row_fails_alone(spark):
    df = spark.createDataFrame([("7", 1.0), ("x", 2.0)], "u string, v double")
    suite = Suite(
        "s",
        (
            NotNull("v", row_condition="CAST(u AS INT) > 5"),
            NotNull("v", row_condition="count(*) > 1"),
            NotNull("v", row_condition="u = '7'"),
            Between("v", low=1),
        ),
    )
    rows = run_suite(df, suite, Run.starting(datetime.datetime(2024, 1, 1))).orderBy("ordinal").collect()
    assert [r.success for r in rows] == [False, False, True, True]
    assert [r.element_count for r in rows] == [None, None, 1, 2]


@pytest.mark.parametrize("bounds", [{"low": 5}, {"low": 5.0}, {"high": 9}, {"low": 1, "high": 9.0}])
def test_nan_lies_outside_whatever_the_kind_of_the_bounds(spark, bounds):
    df = spark.createDataFrame([(6.0,), (float("nan"),), (None,)], "v double")
    row = run_suite(df, Suite("s", (Between("v", **bounds),)), Run.starting(datetime.datetime(2024, 1, 1))).first()
    assert (row.unexpected_count, row.missing_count, row.success) == (1, 1, False)
