"""State that jobs write, read back: results, reports, pages and models must be what was computed."""

from __future__ import annotations

import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.catalog import drift as drift_queries
from plumbline.catalog import metrics, quality
from plumbline.catalog.base import ORACLES, SQL_V2, query, staged_v1, staged_v2, table
from plumbline.operators import features, scoring, training
from plumbline.operators.gauges import exposition, latest_push, write_page
from plumbline.operators.suite import COUNTS, USER_EVENTS_SUITE
from plumbline.plans.drift import measure_drift
from plumbline.plans.validate import validate
from plumbline.session import scratch_path
from plumbline.sources.tables import append_rows


@query("stored_results", f"WITH {SQL_V2} {quality.SQL_USER_EVENTS}")
def stored_results(spark, sf_dir):
    """The result history of a validation run."""
    place = scratch_path(spark, "validation")
    staged = staged_v2(table(spark, sf_dir, "events"))
    validate([(staged, USER_EVENTS_SUITE)], "stg", quality.RUN, f"{place}/results", f"{place}/metrics", level=COUNTS)
    return spark.read.parquet(f"{place}/results").drop("run_date")


@query("stored_drift_report", ORACLES["drift_report"])
def stored_drift_report(spark, sf_dir):
    """The report history of a drift run."""
    place = scratch_path(spark, "drift")
    staged = staged_v1(table(spark, sf_dir, "events"))
    at = datetime.datetime(2024, 2, 1, 12)
    measure_drift(staged, ["ts", "event_id"], drift_queries.EVENT_COLUMNS, at, f"{place}/report", f"{place}/metrics")
    return drift_queries.rounded(spark.read.parquet(f"{place}/report/columns").drop("run_time", "run_date"))


@query("stored_page", f"SELECT line FROM ({ORACLES['metrics_exposition']})")
def stored_page(spark, sf_dir) -> DataFrame:
    """The page of the latest pushes of a metric table that was written and read again."""
    place = scratch_path(spark, "metrics")
    pushes = metrics.pushes(table(spark, sf_dir, "events"))
    append_rows(pushes, f"{place}/log")
    write_page(exposition(latest_push(spark.read.parquet(f"{place}/log"))), f"{place}/page")
    return spark.read.text(f"{place}/page").select(F.col("value").alias("line"))


@query("stored_features", ORACLES["assemble_features"])
def stored_features(spark, sf_dir):
    """Features by a model and an index table that were stored and loaded."""
    uri = scratch_path(spark, "model")
    staged = staged_v1(table(spark, sf_dir, "events")).fillna(0.0, ["purchase_value"])
    columns = ["user_id", "page"]
    features.category_table(staged, columns).write.parquet(training.categories_path(uri))
    indexes = spark.read.parquet(training.categories_path(uri))
    indexed = features.index_categories(staged, columns, indexes)
    stages = [features.label_indexer("event_type"), features.assembler([*(f"{c}_index" for c in columns), "purchase_value"])]
    training.save_model(features.fit_features(stages, indexed), uri)
    parts = vector_to_array("features")
    return scoring.score(training.load_model(uri), indexed).select(
        "event_id",
        "label",
        parts[0].alias("user_id_index"),
        parts[1].alias("page_index"),
        parts[2].alias("purchase_value"),
    )
