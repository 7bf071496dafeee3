import datetime

from plumbline.operators.payload import fill_missing, parse_events, stage_events
from plumbline.sources.tables import minutes_between

PAYLOADS = [
    '{"user_id":"u1","event_type":"click","timestamp":"2024-01-01T00:00:07Z","page":"/home","value":1.5}',
    "not json",
    '{"user_id":7,"event_type":"click","timestamp":"garbage","value":"5"}',
    '{"user_id":"u2","extra":1,"timestamp":"2024-01-01 10:11:12.5","value":3}',
    '{"user_id":"u3","event_type":"click","timestamp":"2024-01-01T00:00:07+02:00","value":null}',
    "",
    None,
]


def parsed(spark, as_binary):
    raw = spark.createDataFrame([(p,) for p in PAYLOADS], "value string")
    if as_binary:
        raw = raw.selectExpr("cast(value as binary) as value")
    return [tuple(r) for r in parse_events(raw).collect()]


def test_payload_cases(spark):
    rows = parsed(spark, as_binary=True)
    at = datetime.datetime
    nothing = (None,) * 6
    assert rows[0] == ("u1", "click", "/home", 1.5, at(2024, 1, 1, 0, 0, 7), "2024-01-01-00-00")
    assert rows[1] == nothing
    assert rows[2] == ("7", "click", None, None, None, None)
    assert rows[3] == ("u2", None, None, 3.0, at(2024, 1, 1, 10, 11, 12, 500000), "2024-01-01-10-11")
    assert rows[4] == ("u3", "click", None, None, at(2023, 12, 31, 22, 0, 7), "2023-12-31-22-00")
    assert rows[5] == nothing and rows[6] == nothing


def test_text_and_binary_payloads_give_the_same(spark):
    assert parsed(spark, True) == parsed(spark, False)


def test_staging_renames_and_fill_touches_only_its_columns(spark):
    raw = spark.createDataFrame([(p,) for p in PAYLOADS], "value string")
    staged = stage_events(parse_events(raw))
    assert staged.columns == ["user_id", "event_type", "page", "ts", "purchase_value"]
    filled = fill_missing(staged, ["purchase_value"]).collect()
    assert [r.purchase_value for r in filled] == [1.5, 0.0, 0.0, 3.0, 0.0, 0.0, 0.0]
    assert filled[1].user_id is None


def test_minute_range_prunes_partitions(spark, tmp_path):
    raw = spark.createDataFrame([(p,) for p in PAYLOADS], "value string")
    parse_events(raw).write.partitionBy("event_minute").parquet(str(tmp_path / "bronze"))
    read = minutes_between(spark.read.parquet(str(tmp_path / "bronze")), "2024-01-01-00-00", "2024-01-01-00-59")
    assert [r.user_id for r in read.collect()] == ["u1"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_minute" in plan
