"""Every query with SQL of its own must give the rows that SQL gives."""

import pytest
from conftest import SF_ORACLE, SF_SMALL
from oracle import connect, spark_rows, sql_rows

from plumbline.catalog import ORACLES, QUERIES


# one file per minute makes this one slow on a local disk
SMALLER = {"ingest_stream_minute_counts"}


@pytest.fixture(scope="module")
def con():
    return {sf: connect(sf) for sf in (SF_SMALL, SF_ORACLE)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, con, name):
    sf = SF_SMALL if name in SMALLER else SF_ORACLE
    columns, rows = spark_rows(QUERIES[name](spark, sf))
    expected_columns, expected = sql_rows(con[sf], ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
