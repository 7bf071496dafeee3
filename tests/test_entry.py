import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_contract(spark):
    entry = load()
    rows = entry.entry(spark).collect()
    assert len(rows) == 11 and {r.suite for r in rows} == {"user_events_delta_suite"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_work_under_any_session_zone(spark):
    queries = load().queries()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        first = queries["ingest_parse_events"](spark, "/root/testdata/sf0.001").orderBy("event_timestamp").first()
        assert first.event_minute == "2024-01-01-" + first.event_timestamp.strftime("%H-%M")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
