"""Row shapes of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the event payload.
EVENT_PAYLOAD = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Fixed value: layout of the minute partition key.
MINUTE_FORMAT = "yyyy-MM-dd-HH-mm"

RAW_EVENT = "value BINARY"

BRONZE_EVENT = (
    "user_id STRING, event_type STRING, page STRING, value DOUBLE, "
    "event_timestamp TIMESTAMP, event_minute STRING"
)

STAGED_EVENT = (
    "user_id STRING, event_type STRING, page STRING, ts TIMESTAMP, purchase_value DOUBLE"
)

CHECK_RESULT = (
    "run_id STRING, run_time TIMESTAMP, suite STRING, ordinal INT, expectation STRING, "
    "column STRING, element_count BIGINT, missing_count BIGINT, unexpected_count BIGINT, "
    "mostly DOUBLE, success BOOLEAN"
)

DRIFT_COLUMN = (
    "column STRING, kind STRING, method STRING, statistic DOUBLE, p_value DOUBLE, "
    "threshold DOUBLE, drifted BOOLEAN, n_ref BIGINT, n_cur BIGINT"
)

DRIFT_SUMMARY = (
    "n_columns INT, drifted_count INT, drifted_share DOUBLE, dataset_drift BOOLEAN"
)

METRIC = (
    "run_time TIMESTAMP, job STRING, name STRING, help STRING, "
    "labels MAP<STRING,STRING>, value DOUBLE"
)

TRIAL = "trial_id INT, c DOUBLE, solver STRING, accuracy DOUBLE"

LEDGER = (
    "search_id STRING, trial_id INT, c DOUBLE, solver STRING, accuracy DOUBLE, finished_at TIMESTAMP"
)

MODEL_VERSION = (
    "name STRING, version INT, run_id STRING, uri STRING, registered_at TIMESTAMP"
)

MODEL_ALIAS = "name STRING, alias STRING, version INT, assigned_at TIMESTAMP"

RUN_LOG = "run_id STRING, kind STRING, key STRING, value STRING"
