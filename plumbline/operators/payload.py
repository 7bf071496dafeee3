"""From raw payload bytes to typed events, and from typed events to the staging table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.schemas import EVENT_PAYLOAD, MINUTE_FORMAT

# Staging name of each bronze column.
STAGING_NAMES = {
    "user_id": "user_id",
    "event_type": "event_type",
    "page": "page",
    "event_timestamp": "ts",
    "value": "purchase_value",
}


def parse_events(raw: DataFrame, payload: T.StructType = EVENT_PAYLOAD) -> DataFrame:
    """Typed bronze rows from a column ``value`` of JSON bytes or text; batch or stream.

    A payload that is no JSON becomes a row of NULLs and is kept.  A timestamp text that
    cannot be read becomes NULL, and so does its minute key.
    """
    body = raw.select(F.from_json(F.col("value").cast("string"), payload).alias("body"))
    typed = body.select(
        "body.user_id",
        "body.event_type",
        "body.page",
        "body.value",
        F.try_to_timestamp(F.col("body.timestamp")).alias("event_timestamp"),
    )
    return typed.select("*", F.date_format("event_timestamp", MINUTE_FORMAT).alias("event_minute"))


def stage_events(bronze: DataFrame, names: Mapping[str, str] = STAGING_NAMES) -> DataFrame:
    """The staging projection the checks, drift and training jobs read."""
    return bronze.select([F.col(source).alias(target) for source, target in names.items()])


def fill_missing(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    """Replace NULL (and NaN) in the named columns only."""
    return df.fillna(value, subset=columns)
