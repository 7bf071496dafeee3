import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.catalog.quality import RUN
from plumbline.operators import suite as suites
from plumbline.operators.conditions import ConditionError, parse
from plumbline.operators.definitions import CHECKPOINT, SUITE, Checkpoint, Definitions, suite_body, suite_from
from plumbline.operators.expectations import Between, ColumnExists, Expectation, InSet, NotNull, OfType
from plumbline.operators.suite import COUNTS, Suite, run_suite

ROWS = [
    (0, "purchase", 5.0, True, datetime.datetime(2024, 1, 1, 12), datetime.date(2024, 1, 1), 3),
    (1, "click", None, False, datetime.datetime(2024, 1, 2), datetime.date(2024, 1, 2), 4),
    (2, None, -1.5, None, None, None, None),
    (3, 'say "hi" \\', 100.0, True, datetime.datetime(2024, 1, 3), datetime.date(2024, 1, 3), 100),
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "id int, `event type` string, value double, ok boolean, ts timestamp, day date, other bigint")


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ('col("event type") == "purchase"', {0}),
        ("col('event type') != 'purchase'", {1, 3}),
        ('"purchase" == col("event type")', {0}),
        ('col("event type") == "say \\"hi\\" \\\\"', {3}),
        ('col("value") > -2 and col("value") <= 5.0', {0, 2}),
        ('-2 < col("value") <= 5', {0, 2}),
        ('(col("value") == 5) | (col("event type") == "click")', {0, 1}),
        ('~(col("ok")) & col("event type").notNull()', {1}),
        ('not col("ok") == True', {1}),
        ('col("ok")', {0, 3}),
        ('col("value").isNull() or col("event type").isNull()', {1, 2}),
        ('col("value").isNotNull()', {0, 2, 3}),
        ('col("event type") in ["click", "purchase"]', {0, 1}),
        ('col("id") in (1, 3.0)', {1, 3}),
        ('col("ts") >= "2024-01-02"', {1, 3}),
        ('col("day") < "2024-01-02"', {0}),
        ('col("value") == col("other")', {3}),
        ('  col("id") < 1\n', {0}),
    ],
)
def test_conditions_that_are_understood(frame, text, ids):
    assert {r.id for r in frame.where(parse(text, frame.schema)).collect()} == ids


@pytest.mark.parametrize(
    "text",
    [
        "", "1 == 1", "col('nothing') == 1", "col(value) == 1", "col('value')", "col('value') == 'five'", "col('event type') == 5",
        "col('ok') == 1", "col('value') == None", "col('ts') == 'someday'", "col('value') = 5", "__import__('os').system('true')",
        "col('value').cast('int') == 1", "col('value') in col('other')", "col('value') == col('event type')", "col('value') + 1 == 2",
        "lambda: 1", "col('value', 'x') == 1", "col('value').isNull(1)", "(" * 500 + "col('ok')" + ")" * 500, "not " * 5000 + "col('ok')", "event_type = 'x'",
        "col('event type') == -'x'", "col('value') == 1 if col('ok') else col('ok')",
    ],
)
def test_anything_else_is_refused(frame, text):
    with pytest.raises(ConditionError):
        parse(text, frame.schema)


def test_a_condition_that_is_refused_fails_its_check_alone(frame):
    checks = (
        Between("value", row_condition="col('ok')", condition_language="col", low=0.0, high=50.0),
        Between("value", row_condition="col('gone') == 1", condition_language="col", low=0.0, high=50.0),
        Between("value", row_condition="col('ok')", condition_language="klingon", low=0.0, high=50.0),
        NotNull("id"),
    )
    rows = run_suite(frame, Suite("s", checks), RUN).orderBy("ordinal").collect()
    assert [(r.element_count, r.unexpected_count, r.success) for r in rows] == [(2, 1, False), (None, None, False), (None, None, False), (4, 0, True)]


def test_a_suite_with_conditions_is_scanned_once(spark, frame, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = frame.mapInArrow(count, frame.schema)
    checks = (NotNull("id", row_condition="ok"), Between("value", row_condition="col('id') < 3", condition_language="col", low=0.0))
    rows = run_suite(counted, Suite("s", checks), RUN).orderBy("ordinal").collect()
    assert [r.element_count for r in rows] == [2, 3] and seen.value == 4


def test_only_values_make_a_condition_fail(spark, frame, tmp_path):
    bad = NotNull("id", row_condition="cast(`event type` as int) > 1")
    rows = run_suite(frame, Suite("s", (bad, NotNull("id", row_condition="1 / (id - 1) > 0"), NotNull("id", row_condition="id > 0"))), RUN).orderBy("ordinal").collect()
    assert [(r.success, r.element_count) for r in rows] == [(False, None), (False, None), (True, 3)]
    frame.write.parquet(str(tmp_path / "gone"))
    lost = spark.read.parquet(str(tmp_path / "gone"))
    for file in (tmp_path / "gone").glob("part-*"):
        file.write_bytes(b"no parquet any more")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        run_suite(lost, Suite("s", (NotNull("id", row_condition="id > 0"),)), RUN).collect()


EVERY = Suite(
    "every",
    (
        ColumnExists("a"),
        OfType("a", "LongType"),
        NotNull("a", mostly=0.5, row_condition="a > 1"),
        InSet("b", values=("x", "ü", None, 3, 2.5, True)),
        InSet("c", values=(Decimal("1.50"), datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1, 2, 3, 4, 5))),
        Between("d", low=datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc), high=None, condition_language="col"),
    ),
)


def test_suites_survive_being_stored():
    assert suite_from("every", suite_body(EVERY)) == EVERY

    class Own(Expectation):
        kind = "not_null"

    with pytest.raises(TypeError):
        suite_body(Suite("own", (Own("a"),)))


def test_definitions_are_added_changed_and_dropped(spark, frame, tmp_path):
    kept = Definitions(spark, str(tmp_path / "definitions"))
    assert kept.current(SUITE).count() == 0
    assert kept.add_or_update(Suite("one", (NotNull("id"),))) == 1
    kept.add_or_update(EVERY)
    kept.add_or_update(Suite("one", (NotNull("value"),)))
    assert kept.suite("one") == Suite("one", (NotNull("value"),)) and kept.suite("every") == EVERY
    frame.write.parquet(str(tmp_path / "table"))
    checkpoint = Checkpoint("all", ((str(tmp_path / "table"), "one"),), COUNTS)
    kept.add_or_update(checkpoint)
    assert kept.checkpoint("all") == checkpoint
    assert [r.success for r in kept.run("all", RUN).collect()] == [False]
    kept.drop(SUITE, "one")
    for gone in (lambda: kept.suite("one"), lambda: kept.run("all", RUN), lambda: kept.drop(SUITE, "one"), lambda: kept.checkpoint("none")):
        with pytest.raises(LookupError):
            gone()
    kept.add_or_update(Suite("one", (NotNull("id"),)))
    assert [r.success for r in kept.run("all", RUN).collect()] == [True]
    assert sorted(r.name for r in kept.current(SUITE).collect()) == ["every", "one"] and kept.current(CHECKPOINT).count() == 1
    assert kept.log.count() == 6 and kept.current(SUITE).where(F.col("name") == "one").first().number == 6
    assert suites.BOOLEAN_ONLY == Checkpoint("x", ()).level
