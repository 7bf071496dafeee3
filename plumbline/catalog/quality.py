"""Checks and suites."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from plumbline.catalog.base import SQL_V2, query, staged_v2, table
from plumbline.operators.definitions import SUITE, Checkpoint, Definitions
from plumbline.operators.expectations import Between, ColumnExists, InSet, NotNull, OfType
from plumbline.operators.gauges import validation_gauge
from plumbline.operators.suite import (
    BOOLEAN_ONLY,
    USER_EVENTS_SUITE,
    Run,
    Suite,
    at_level,
    overall,
    run_checkpoint,
    run_suite,
)
from plumbline.session import scratch_path

RUN = Run.starting(datetime.datetime(2024, 2, 1, 12, 0, 0))
SQL_RUN = "'delta_validation_run_20240201_120000' AS run_id, TIMESTAMP '2024-02-01 12:00:00' AS run_time"


def _staged(spark, sf_dir):
    return staged_v2(table(spark, sf_dir, "events"))


def _sql_row(suite, ordinal, kind, column, mostly, elements, missing, unexpected, success):
    return f"""SELECT {SQL_RUN}, '{suite}' AS suite, {ordinal} AS ordinal, '{kind}' AS expectation,
    '{column}' AS "column", {elements} AS element_count, {missing} AS missing_count,
    {unexpected} AS unexpected_count, CAST({mostly} AS DOUBLE) AS mostly, {success} AS success"""


def _sql_schema_check(suite, ordinal, kind, column, holds, source="stg"):
    nothing = "CAST(NULL AS BIGINT)"
    row = _sql_row(suite, ordinal, kind, column, "NULL", "count(*)", nothing, nothing, holds)
    return f"{row} FROM {source}"


def _sql_not_null(suite, ordinal, column, source="stg"):
    missing = f"count(*) FILTER ({column} IS NULL)"
    row = _sql_row(suite, ordinal, "not_null", column, 1.0, "count(*)", missing, missing, f"{missing} = 0")
    return f"{row} FROM {source}"


def _sql_values(suite, ordinal, kind, column, mostly, bad, source="stg", where="true"):
    missing = f"count(*) FILTER ({where} AND {column} IS NULL)"
    filled = f"count(*) FILTER ({where} AND {column} IS NOT NULL)"
    unexpected = f"count(*) FILTER ({where} AND {column} IS NOT NULL AND ({bad}))"
    success = f"({filled} = 0 OR ({filled} - {unexpected}) / {filled} >= {mostly})"
    elements = f"count(*) FILTER ({where})"
    row = _sql_row(suite, ordinal, kind, column, mostly, elements, missing, unexpected, success)
    return f"{row} FROM {source}"


# The value sets and the range of the staged events' suite, as the SQL has them.
TYPES_SQL = "event_type NOT IN ('click', 'page_view', 'purchase', 'add_to_cart')"
PAGES_SQL = "page NOT IN ('/home', '/products/1', '/products/2', '/cart', '/checkout')"
RANGE_SQL = "purchase_value < 5.0 OR purchase_value > 100.0"


@query(
    "dq_column_exists",
    f"WITH {SQL_V2} "
    + _sql_schema_check("exists", 0, "column_exists", "user_id", "true")
    + " UNION ALL "
    + _sql_schema_check("exists", 1, "column_exists", "session_id", "false"),
)
def dq_column_exists(spark, sf_dir):
    suite = Suite("exists", (ColumnExists("user_id"), ColumnExists("session_id")))
    return run_suite(_staged(spark, sf_dir), suite, RUN)


@query(
    "dq_of_type",
    f"WITH {SQL_V2} "
    + _sql_schema_check("types", 0, "of_type", "ts", "true")
    + " UNION ALL "
    + _sql_schema_check("types", 1, "of_type", "purchase_value", "false"),
)
def dq_of_type(spark, sf_dir):
    suite = Suite("types", (OfType("ts", "TimestampType"), OfType("purchase_value", "LongType")))
    return run_suite(_staged(spark, sf_dir), suite, RUN)


@query(
    "dq_not_null",
    f"WITH {SQL_V2} "
    + _sql_not_null("nulls", 0, "user_id")
    + " UNION ALL "
    + _sql_not_null("nulls", 1, "purchase_value"),
)
def dq_not_null(spark, sf_dir):
    suite = Suite("nulls", (NotNull("user_id"), NotNull("purchase_value")))
    return run_suite(_staged(spark, sf_dir), suite, RUN)


@query(
    "dq_in_set",
    f"WITH {SQL_V2} "
    + _sql_values("sets", 0, "in_set", "event_type", 1.0, TYPES_SQL)
    + " UNION ALL "
    + _sql_values("sets", 1, "in_set", "page", 1.0, PAGES_SQL),
)
def dq_in_set(spark, sf_dir):
    checks = tuple(e for e in USER_EVENTS_SUITE.expectations if isinstance(e, InSet))
    return run_suite(_staged(spark, sf_dir), Suite("sets", checks), RUN)


@query(
    "dq_between_mostly",
    f"WITH {SQL_V2} "
    + _sql_values("ranges", 0, "between", "purchase_value", 0.95, RANGE_SQL)
    + " UNION ALL "
    + _sql_values("ranges", 1, "between", "purchase_value", 0.5, RANGE_SQL),
)
def dq_between_mostly(spark, sf_dir):
    checks = tuple(Between("purchase_value", mostly=m, low=5.0, high=100.0) for m in (0.95, 0.5))
    return run_suite(_staged(spark, sf_dir), Suite("ranges", checks), RUN)


@query(
    "dq_row_condition",
    f"WITH {SQL_V2} "
    + _sql_values(
        "conditions", 0, "between", "purchase_value", 0.95, RANGE_SQL, where="event_type = 'purchase'"
    )
    + " UNION ALL "
    + _sql_values(
        "conditions", 1, "in_set", "page", 1.0, "page NOT IN ('/cart')", where="event_type = 'click'"
    ),
)
def dq_row_condition(spark, sf_dir):
    checks = (
        Between("purchase_value", mostly=0.95, row_condition="event_type = 'purchase'", low=5.0, high=100.0),
        InSet("page", row_condition="event_type = 'click'", values=("/cart",)),
    )
    return run_suite(_staged(spark, sf_dir), Suite("conditions", checks), RUN)


SQL_CONDITION_TEXT = " UNION ALL ".join(
    [
        _sql_values("texts", 0, "between", "purchase_value", 0.95, RANGE_SQL, where="event_type = 'purchase'"),
        _sql_values("texts", 1, "between", "purchase_value", 0.95, RANGE_SQL, where="event_type = 'purchase'"),
        _sql_values(
            "texts", 2, "in_set", "page", 0.2, "page NOT IN ('/cart')",
            where="event_type IN ('click', 'page_view') AND NOT (page = '/home' OR ts < TIMESTAMP '2024-01-10 00:00:00') AND purchase_value IS NULL",
        ),
        _sql_schema_check("texts", 3, "between", "purchase_value", "false").replace("count(*) AS element_count", "CAST(NULL AS BIGINT) AS element_count").replace(
            "CAST(NULL AS DOUBLE) AS mostly", "CAST(1.0 AS DOUBLE) AS mostly"
        ).replace(" FROM stg", ""),
    ]
)


@query("dq_condition_text", f"WITH {SQL_V2} {SQL_CONDITION_TEXT}")
def dq_condition_text(spark, sf_dir):
    """Conditions in both languages; one that names no column fails its check alone."""
    limits = {"mostly": 0.95, "low": 5.0, "high": 100.0}
    checks = (
        Between("purchase_value", row_condition="event_type = 'purchase'", **limits),
        Between("purchase_value", row_condition='col("event_type") == "purchase"', condition_language="col", **limits),
        InSet(
            "page",
            mostly=0.2,
            row_condition='col("event_type") in ["click", "page_view"] and not (col("page") == "/home" or col("ts") < "2024-01-10") and col("purchase_value").isNull()',
            condition_language="col",
            values=("/cart",),
        ),
        Between("purchase_value", row_condition='col("event_kind") == "purchase"', condition_language="col", low=5.0, high=100.0),
    )
    return run_suite(_staged(spark, sf_dir), Suite("texts", checks), RUN)


def _sql_unusual(column: str) -> str:
    return f"CASE event_id % 7 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE WHEN 3 THEN NULL ELSE {column} END"


def unusual(column: str):
    """A number column with NaN, infinite and missing values among the others."""
    kind = F.col("event_id") % 7
    number = F.when(kind == 0, float("nan")).when(kind == 1, float("inf")).when(kind == 2, float("-inf"))
    return number.when(kind > 3, F.col(column))


@query(
    "dq_between_nan",
    f"WITH stg AS (SELECT {_sql_unusual('value')} AS x FROM events) "
    + " UNION ALL ".join(
        [
            _sql_values("nan", 0, "between", "x", 0.4, "isnan(x) OR x < 5.0 OR x > 100.0"),
            _sql_values("nan", 1, "between", "x", 0.4, "isnan(x) OR x < 5.0"),
            _sql_values("nan", 2, "between", "x", 0.4, "isnan(x) OR x > 100.0"),
        ]
    ),
)
def dq_between_nan(spark, sf_dir):
    """NaN lies outside of every range, infinite values where they sort."""
    rows = table(spark, sf_dir, "events").select(unusual("value").alias("x"))
    ends = ({"low": 5.0, "high": 100.0}, {"low": 5.0}, {"high": 100.0})
    return run_suite(rows, Suite("nan", tuple(Between("x", mostly=0.4, **e) for e in ends)), RUN)


_NAME = USER_EVENTS_SUITE.name
SQL_USER_EVENTS = " UNION ALL ".join(
    [
        _sql_schema_check(_NAME, 0, "column_exists", "user_id", "true"),
        _sql_not_null(_NAME, 1, "user_id"),
        _sql_schema_check(_NAME, 2, "column_exists", "event_type", "true"),
        _sql_values(_NAME, 3, "in_set", "event_type", 1.0, TYPES_SQL),
        _sql_schema_check(_NAME, 4, "column_exists", "page", "true"),
        _sql_values(_NAME, 5, "in_set", "page", 1.0, PAGES_SQL),
        _sql_schema_check(_NAME, 6, "column_exists", "ts", "true"),
        _sql_not_null(_NAME, 7, "ts"),
        _sql_schema_check(_NAME, 8, "of_type", "ts", "true"),
        _sql_schema_check(_NAME, 9, "column_exists", "purchase_value", "true"),
        _sql_values(_NAME, 10, "between", "purchase_value", 0.95, RANGE_SQL),
    ]
)


@query("dq_suite_results", f"WITH {SQL_V2} {SQL_USER_EVENTS}")
def dq_suite_results(spark, sf_dir):
    return run_suite(_staged(spark, sf_dir), USER_EVENTS_SUITE, RUN)


@query(
    "dq_boolean_only",
    f"""WITH {SQL_V2}, results AS ({SQL_USER_EVENTS})
    SELECT run_id, run_time, suite, ordinal, expectation, "column", success FROM results""",
)
def dq_boolean_only(spark, sf_dir):
    return at_level(run_suite(_staged(spark, sf_dir), USER_EVENTS_SUITE, RUN), BOOLEAN_ONLY)


ORDERS_SUITE = Suite(
    "orders_suite",
    (
        NotNull("o_custkey"),
        InSet("o_orderstatus", values=("O", "P", "F")),
        Between("o_totalprice", mostly=0.9, low=1000.0, high=400000.0),
    ),
)
LINEITEM_SUITE = Suite(
    "lineitem_suite",
    (
        NotNull("l_shipdate"),
        InSet("l_returnflag", values=("A", "N")),
        Between("l_quantity", low=1.0, high=50.0),
        Between("l_discount", mostly=0.8, row_condition="l_linestatus = 'O'", low=0.01, high=0.09),
    ),
)
SQL_ORDERS = " UNION ALL ".join(
    [
        _sql_not_null("orders_suite", 0, "o_custkey", "orders"),
        _sql_values(
            "orders_suite", 1, "in_set", "o_orderstatus", 1.0, "o_orderstatus NOT IN ('O', 'P', 'F')", "orders"
        ),
        _sql_values(
            "orders_suite", 2, "between", "o_totalprice", 0.9,
            "o_totalprice < 1000.0 OR o_totalprice > 400000.0", "orders",
        ),
    ]
)
SQL_LINEITEM = " UNION ALL ".join(
    [
        _sql_not_null("lineitem_suite", 0, "l_shipdate", "lineitem"),
        _sql_values(
            "lineitem_suite", 1, "in_set", "l_returnflag", 1.0, "l_returnflag NOT IN ('A', 'N')", "lineitem"
        ),
        _sql_values(
            "lineitem_suite", 2, "between", "l_quantity", 1.0, "l_quantity < 1.0 OR l_quantity > 50.0", "lineitem"
        ),
        _sql_values(
            "lineitem_suite", 3, "between", "l_discount", 0.8,
            "l_discount < 0.01 OR l_discount > 0.09", "lineitem", "l_linestatus = 'O'",
        ),
    ]
)
SQL_ALL = f"{SQL_USER_EVENTS} UNION ALL {SQL_ORDERS} UNION ALL {SQL_LINEITEM}"


def _three_tables(spark, sf_dir):
    bound = [
        (_staged(spark, sf_dir), USER_EVENTS_SUITE),
        (table(spark, sf_dir, "orders"), ORDERS_SUITE),
        (table(spark, sf_dir, "lineitem"), LINEITEM_SUITE),
    ]
    return run_checkpoint(bound, RUN)


@query("dq_checkpoint_results", f"WITH {SQL_V2} {SQL_ALL}")
def dq_checkpoint_results(spark, sf_dir):
    return _three_tables(spark, sf_dir)


@query(
    "dq_checkpoint",
    f"""WITH {SQL_V2}, results AS ({SQL_ALL})
    SELECT run_id, run_time, bool_and(success) AS success, count(*) AS checks FROM results GROUP BY 1, 2""",
)
def dq_checkpoint(spark, sf_dir):
    return overall(_three_tables(spark, sf_dir))


@query(
    "dq_gauge",
    f"""WITH {SQL_V2}, results AS ({SQL_USER_EVENTS})
    SELECT max(run_time) AS run_time, 'gx_data_validation' AS job, 'data_valition_result' AS name,
    'Data Validation' AS help, 'stg_user_events_v2' AS table_name,
    CASE WHEN bool_and(success) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM results""",
)
def dq_gauge(spark, sf_dir):
    verdict = overall(run_suite(_staged(spark, sf_dir), USER_EVENTS_SUITE, RUN))
    made = validation_gauge(verdict, "stg_user_events_v2")
    return made.selectExpr(
        "run_time", "job", "name", "help", "labels['table_name'] AS table_name", "value"
    )


@query(
    "stored_suite",
    " UNION ALL ".join(
        [
            _sql_values("stored", 0, "in_set", "o_orderstatus", 1.0, "o_orderstatus NOT IN ('O', 'P', 'F')", "orders"),
            _sql_values(
                "stored", 1, "between", "o_orderdate", 0.9, "o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '1999-06-01'", "orders",
                "o_orderpriority = '1-URGENT'",
            ),
            _sql_not_null("other", 0, "l_shipdate", "lineitem"),
        ]
    ),
)
def stored_suite(spark, sf_dir):
    """A stored checkpoint over two stored suites, one of which was changed since and one dropped and added again."""
    kept = Definitions(spark, scratch_path(spark, "definitions"))
    kept.add_or_update(Suite("stored", (NotNull("o_custkey"),)))
    kept.add_or_update(Suite("other", (NotNull("l_comment"), ColumnExists("nothing"))))
    kept.add_or_update(Checkpoint("nightly", ((f"{sf_dir}/orders.parquet", "other"),)))
    days = [datetime.datetime(1996, 1, 1), datetime.datetime(1999, 6, 1)]
    urgent = {"row_condition": 'col("o_orderpriority") == "1-URGENT"', "condition_language": "col"}
    kept.add_or_update(Suite("stored", (InSet("o_orderstatus", values=("O", "P", "F")), Between("o_orderdate", mostly=0.9, low=days[0], high=days[1], **urgent))))
    kept.drop(SUITE, "other")
    kept.add_or_update(Suite("other", (NotNull("l_shipdate"),)))
    kept.add_or_update(Checkpoint("nightly", ((f"{sf_dir}/orders.parquet", "stored"), (f"{sf_dir}/lineitem.parquet", "other"))))
    return kept.run("nightly", RUN)
