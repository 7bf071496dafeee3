"""Ingest, staging and table reads."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.catalog.base import SQL_PAGE, SQL_V2, query, staged_v2, table, visited_page
from plumbline.operators.payload import fill_missing, parse_events, stage_events
from plumbline.operators.profile import merged_profile, profile, sketch_rows
from plumbline.session import scratch_path
from plumbline.sources.log import append_batch, load_version
from plumbline.sources.streams import replay_events
from plumbline.sources.tables import as_of, load_table
from plumbline.streaming.batches import replace_batch
from plumbline.streaming.ingest import block_on, start_batch_ingest


def payload(timestamp: Column | None = None) -> Column:
    """An event as the JSON text its producer would send."""
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("user_id"),
            "event_type",
            (written if timestamp is None else timestamp).alias("timestamp"),
            visited_page().alias("page"),
            "value",
        )
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(payload().cast("binary").alias("value"))


@query(
    "ingest_parse_events",
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, {SQL_PAGE} AS page, value,
    ts AS event_timestamp, strftime(ts, '%Y-%m-%d-%H-%M') AS event_minute FROM events""",
)
def ingest_parse_events(spark, sf_dir):
    return parse_events(raw_events(spark, sf_dir))


@query(
    "ingest_malformed_rows",
    f"""SELECT CASE WHEN event_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 10 <> 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 10 <> 0 THEN {SQL_PAGE} END AS page,
    CASE WHEN event_id % 10 <> 0 THEN value END AS value,
    CASE WHEN event_id % 10 > 1 THEN ts END AS event_timestamp,
    CASE WHEN event_id % 10 > 1 THEN strftime(ts, '%Y-%m-%d-%H-%M') END AS event_minute
    FROM events""",
)
def ingest_malformed_rows(spark, sf_dir):
    """Every tenth payload is no JSON and every tenth has a timestamp that is none."""
    slot = F.col("event_id") % 10
    value = (
        F.when(slot == 0, F.lit("not json"))
        .when(slot == 1, payload(F.lit("garbage")))
        .otherwise(payload())
    )
    return parse_events(table(spark, sf_dir, "events").select(value.alias("value")))


@query(
    "ingest_stream_minute_counts",
    """SELECT strftime(ts, '%Y-%m-%d-%H-%M') AS event_minute, count(*) AS n_events,
    round(sum(value), 6) AS total_value FROM events GROUP BY 1""",
)
def ingest_stream_minute_counts(spark, sf_dir):
    """All events through the stream: payload files in, ranges of minutes out, then counted."""
    replay, sink, log = (scratch_path(spark, name) for name in ("replay", "bronze", "progress"))
    raw_events(spark, sf_dir).select(F.col("value").cast("string")).write.text(replay)
    block_on(start_batch_ingest(replay_events(spark, replay), sink, log, interval=None, rows_per_file=20_000))
    bronze = load_version(spark, sink)
    return bronze.groupBy("event_minute").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 6).alias("total_value")
    )


@query(
    "stage_user_events",
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, {SQL_PAGE} AS page, ts,
    value AS purchase_value FROM events""",
)
def stage_user_events(spark, sf_dir):
    return stage_events(parse_events(raw_events(spark, sf_dir)))


@query(
    "feature_fillna",
    f"""WITH {SQL_V2} SELECT user_id, event_type, page, ts,
    coalesce(purchase_value, 0.0) AS purchase_value FROM stg""",
)
def feature_fillna(spark, sf_dir):
    return fill_missing(staged_v2(table(spark, sf_dir, "events")), ["purchase_value"])


@query(
    "table_profile",
    f"""WITH {SQL_V2}, n AS (SELECT count(*) AS row_count, count(user_id) AS c0,
    count(event_type) AS c1, count(page) AS c2, count(ts) AS c3, count(purchase_value) AS c4 FROM stg)
    SELECT 0 AS ordinal, 'user_id' AS "column", 'string' AS data_type, 5 AS column_count, row_count, c0 AS non_null_count FROM n
    UNION ALL SELECT 1, 'event_type', 'string', 5, row_count, c1 FROM n
    UNION ALL SELECT 2, 'page', 'string', 5, row_count, c2 FROM n
    UNION ALL SELECT 3, 'ts', 'timestamp', 5, row_count, c3 FROM n
    UNION ALL SELECT 4, 'purchase_value', 'double', 5, row_count, c4 FROM n""",
)
def table_profile(spark, sf_dir):
    return profile(staged_v2(table(spark, sf_dir, "events")))


@query(
    "table_profile_distinct",
    " UNION ALL ".join(
        f"""SELECT {at} AS ordinal, '{c}' AS "column", '{t}' AS data_type, 6 AS column_count, (SELECT count(*) FROM orders) AS row_count,
        (SELECT count({c}) FROM orders) AS non_null_count, (SELECT count(DISTINCT {c}) FROM orders) AS distinct_count"""
        for at, (c, t) in enumerate(
            [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
        )
    ),
)
def table_profile_distinct(spark, sf_dir):
    """Sizes and exact numbers of distinct values, of columns of few values and of unique ones."""
    return profile(table(spark, sf_dir, "orders"), distinct=True)


@query(
    "table_profile_merged",
    f"""WITH {SQL_V2}, part AS (SELECT * FROM stg WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00')
    SELECT 0 AS ordinal, 'user_id' AS "column", 'string' AS data_type, count(*) AS row_count, count(user_id) AS non_null_count FROM part
    UNION ALL SELECT 1, 'event_type', 'string', count(*), count(event_type) FROM part UNION ALL SELECT 2, 'page', 'string', count(*), count(page) FROM part
    UNION ALL SELECT 3, 'ts', 'timestamp', count(*), count(ts) FROM part UNION ALL SELECT 4, 'purchase_value', 'double', count(*), count(purchase_value) FROM part""",
)
def table_profile_merged(spark, sf_dir):
    """A week's profile from stored sketches of hours; its counts are exact."""
    staged = staged_v2(table(spark, sf_dir, "events")).withColumn("hour", F.date_trunc("hour", "ts"))
    path = scratch_path(spark, "sketches")
    sketch_rows(staged, "hour").write.parquet(path)
    week = spark.read.parquet(path).where("hour >= TIMESTAMP '2024-01-08 00:00:00' AND hour < TIMESTAMP '2024-01-15 00:00:00'")
    return merged_profile(week).drop("distinct_estimate", "quantiles")


@query(
    "versioned_read",
    """SELECT event_type, count(*) AS n_events, max(ts) AS last_ts FROM events
    WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""",
)
def versioned_read(spark, sf_dir):
    """The event log as it stood at an earlier moment."""
    then = as_of(table(spark, sf_dir, "events"), "ts", datetime.datetime(2024, 1, 15))
    return then.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("last_ts")
    )


@query(
    "versioned_read_batch",
    """SELECT v.version, event_type, count(*) AS n_events, max(ts) AS last_ts, sum(event_id)::BIGINT AS id_sum
    FROM (SELECT unnest([0, 1, 2]) AS version) v JOIN events ON event_id % 5 % 4 <= v.version AND event_id % 5 <> 3 GROUP BY 1, 2""",
)
def versioned_read_batch(spark, sf_dir):
    """The event log at each of its three versions; a fourth append, and one under a number in between, never finished."""
    events, log = table(spark, sf_dir, "events"), scratch_path(spark, "log")
    slot = F.col("event_id") % 5
    append_batch(events.where(slot.isin(0, 4)), log)
    append_batch(events.where(slot == 2), log)  # replaced by its repeat
    append_batch(events.where(slot == 1), log, 1)
    append_batch(events.where(slot == 2), log)
    replace_batch(events.where(slot == 3), log, 3)
    at = [load_table(spark, log, version=v).withColumn("version", F.lit(v)) for v in range(3)]
    rows = at[0].unionByName(at[1]).unionByName(at[2])
    return rows.groupBy("version", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("last_ts"), F.sum("event_id").alias("id_sum")
    )
