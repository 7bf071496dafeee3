"""Gauge pushes and their text form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.catalog.base import query, table
from plumbline.operators.gauges import exposition, latest_push


def pushes(events: DataFrame) -> DataFrame:
    """The event log read as a log of gauge pushes: each user reports, per day, what they did."""
    return events.select(
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("run_time"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("job"),
        F.concat(F.col("event_type"), F.lit("_value")).alias("name"),
        F.concat(F.lit("Value of the \\ last\n"), F.col("event_type")).alias("help"),
        F.create_map(
            F.lit("event"), F.col("event_id").cast("string"),
            F.lit("props"), F.col("props"),
        ).alias("labels"),
        F.col("value").alias("value"),
    )


SQL_PUSHES = """pushes AS (SELECT date_trunc('day', ts) AS run_time, 'user_' || user_id AS job,
    event_type || '_value' AS name, 'Value of the \\ last' || chr(10) || event_type AS help,
    event_id, props, value FROM events)"""
SQL_LATEST = """latest AS (SELECT p.* FROM pushes p JOIN
    (SELECT job, max(run_time) AS run_time FROM pushes GROUP BY 1) n
    ON p.job = n.job AND p.run_time = n.run_time)"""


@query(
    "metrics_latest_push",
    f"""WITH {SQL_PUSHES}, {SQL_LATEST} SELECT CAST(run_time AS TIMESTAMP) AS run_time, job, name,
    CAST(event_id AS VARCHAR) AS event, props, value FROM latest""",
)
def metrics_latest_push(spark, sf_dir):
    latest = latest_push(pushes(table(spark, sf_dir, "events")))
    return latest.selectExpr(
        "run_time", "job", "name", "labels['event'] AS event", "labels['props'] AS props", "value"
    )


SQL_SERIES = r"""SELECT name, 2 AS part, name || '{event="' || event_id || '",job="' || job || '",props="'
    || replace(props, '"', '\"') || '"} ' || CAST(value AS VARCHAR) AS line FROM latest"""


@query(
    "metrics_exposition",
    f"""WITH {SQL_PUSHES}, {SQL_LATEST}, names AS (SELECT name, max(help) AS help FROM latest GROUP BY 1)
    SELECT name, 0 AS part, '# HELP ' || name || ' ' ||
        replace(replace(help, '\\', '\\\\'), chr(10), '\\n') AS line FROM names
    UNION ALL SELECT name, 1, '# TYPE ' || name || ' gauge' FROM names
    UNION ALL {SQL_SERIES}""",
)
def metrics_exposition(spark, sf_dir):
    return exposition(latest_push(pushes(table(spark, sf_dir, "events"))))
