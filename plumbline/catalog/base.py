"""Registration of queries, and the staged tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import pin_utc
from plumbline.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL twin where SQL can express it."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(function(pin_utc(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, which is how SQL engines compare them."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet")


PAGES = ("/home", "/products/1", "/products/2", "/cart", "/checkout")


def visited_page() -> F.Column:
    slot = F.get_json_object("props", "$.k").cast("int") % len(PAGES)
    chosen = F.when(slot == 0, PAGES[0])
    for at, page in enumerate(PAGES[1:-1], start=1):
        chosen = chosen.when(slot == at, page)
    return chosen.otherwise(PAGES[-1])


def staged_type() -> F.Column:
    return F.when(F.col("event_type") == "view", "page_view").otherwise(F.col("event_type"))


def staged_v1(events: DataFrame) -> DataFrame:
    """Staged events for drift and training."""
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        staged_type().alias("event_type"),
        visited_page().alias("page"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("purchase_value"),
    )


def staged_v2(events: DataFrame) -> DataFrame:
    """Staged events for validation: only purchases carry a value."""
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        staged_type().alias("event_type"),
        visited_page().alias("page"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"),
    )


SQL_PAGE = """CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5
    WHEN 0 THEN '/home' WHEN 1 THEN '/products/1' WHEN 2 THEN '/products/2'
    WHEN 3 THEN '/cart' ELSE '/checkout' END"""
SQL_TYPE = "CASE event_type WHEN 'view' THEN 'page_view' ELSE event_type END"

SQL_V1 = f"""stg AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, {SQL_TYPE} AS event_type,
    {SQL_PAGE} AS page, ts, value AS purchase_value FROM events)"""
SQL_V2 = f"""stg AS (SELECT CAST(user_id AS VARCHAR) AS user_id, {SQL_TYPE} AS event_type,
    {SQL_PAGE} AS page, ts,
    CASE WHEN event_type = 'purchase' THEN value END AS purchase_value FROM events)"""
