"""Gauge rows, push semantics, and the text form that monitoring systems scrape."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Gauge names, label names and job names that dashboards key on (help texts are our own).
VALIDATION_GAUGE = "data_valition_result"
VALIDATION_HELP = "Data Validation"
VALIDATION_LABEL = "table_name"
VALIDATION_JOB = "gx_data_validation"
DRIFT_SCORE_GAUGE = "model_data_drift_score"
DRIFT_SCORE_HELP = "Data drift score"
DRIFT_COUNT_GAUGE = "model_data_drift_detected"
DRIFT_COUNT_HELP = "Number of columns with drift"
DRIFT_LABEL = "model_name"
DRIFT_JOB = "evidently_batch_validation"


def gauge(name: str, help_text: str, labels: dict[str, str], value: Column) -> Column:
    """A gauge as a struct of a metric row's last four columns."""
    pairs = [F.lit(part) for label in labels.items() for part in label]
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(help_text).alias("help"),
        F.create_map(*pairs).cast("map<string,string>").alias("labels"),
        value.cast("double").alias("value"),
    )


def _pushed(job: str, run_time: Column, gauges: list[Column], source: DataFrame) -> DataFrame:
    rows = source.select(run_time.cast("timestamp").alias("run_time"), F.inline(F.array(*gauges)))
    return rows.select("run_time", F.lit(job).alias("job"), "name", "help", "labels", "value")


def validation_gauge(
    verdict: DataFrame,
    table_name: str,
    *,
    name: str = VALIDATION_GAUGE,
    job: str = VALIDATION_JOB,
) -> DataFrame:
    """1.0 where every check of the run held, else 0.0."""
    value = F.when(F.col("success"), 1.0).otherwise(0.0)
    made = gauge(name, VALIDATION_HELP, {VALIDATION_LABEL: table_name}, value)
    return _pushed(job, F.col("run_time"), [made], verdict)


def drift_gauges(
    summary: DataFrame,
    model_name: str,
    run_time: datetime.datetime,
    *,
    job: str = DRIFT_JOB,
) -> DataFrame:
    """Share and number of drifted columns; both are 0 where nothing was tested."""
    labels = {DRIFT_LABEL: model_name}
    score = F.coalesce(F.col("drifted_share"), F.lit(0.0))
    count = F.coalesce(F.col("drifted_count"), F.lit(0))
    made = [
        gauge(DRIFT_SCORE_GAUGE, DRIFT_SCORE_HELP, labels, score),
        gauge(DRIFT_COUNT_GAUGE, DRIFT_COUNT_HELP, labels, count),
    ]
    return _pushed(job, F.lit(run_time), made, summary)


def latest_push(metrics: DataFrame) -> DataFrame:
    """The rows of each job's newest push: a push replaces all the job pushed before.

    The per-job maximum combines before its shuffle, and the join back lets the runtime
    broadcast it when it is small or split a job that holds much of the log.
    """
    newest = metrics.groupBy("job").agg(F.max("run_time").alias("run_time"))
    return metrics.join(newest, ["job", "run_time"], "left_semi").select(*metrics.columns)


def _escaped(text: Column, quotes: bool) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    return F.replace(out, F.lit('"'), F.lit('\\"')) if quotes else out


def _number(value: Column) -> Column:
    return (
        F.when(F.isnan(value), "NaN")
        .when(value == float("inf"), "+Inf")
        .when(value == float("-inf"), "-Inf")
        .otherwise(value.cast("string"))
    )


def exposition(metrics: DataFrame, with_job: bool = True) -> DataFrame:
    """Text lines: per gauge name a HELP line, a TYPE line, then one line per series.

    Columns ``name``, ``part`` (0 help, 1 type, 2 series) and ``line``; ordered by these three
    they form a page.  Series of several jobs stay apart by a ``job`` label.
    """
    labels = F.coalesce(F.col("labels"), F.create_map().cast("map<string,string>"))
    if with_job:
        others = F.map_filter(labels, lambda key, _: key != "job")
        labels = F.map_concat(F.create_map(F.lit("job"), F.col("job")), others)
    entries = F.array_sort(F.map_entries(labels))
    pairs = F.transform(
        entries,
        lambda e: F.concat(e["key"], F.lit('="'), _escaped(F.coalesce(e["value"], F.lit("")), True), F.lit('"')),
    )
    braces = F.when(F.size(pairs) > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))
    series = metrics.select(
        "name",
        F.lit(2).alias("part"),
        F.concat(
            "name", F.coalesce(braces, F.lit("")), F.lit(" "), _number(F.col("value"))
        ).alias("line"),
    )
    names = metrics.groupBy("name").agg(F.max("help").alias("help"))
    heads = names.select(
        "name",
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("part"),
                    F.concat(
                        F.lit("# HELP "), "name", F.lit(" "),
                        _escaped(F.coalesce("help", F.lit("")), False),
                    ).alias("line"),
                ),
                F.struct(
                    F.lit(1).alias("part"),
                    F.concat(F.lit("# TYPE "), "name", F.lit(" gauge")).alias("line"),
                ),
            )
        ),
    )
    return heads.unionByName(series)


def write_page(lines: DataFrame, path: str) -> None:
    """Write exposition lines in page order; parts sort in the order of their file names."""
    lines.orderBy("name", "part", "line").select("line").write.mode("overwrite").text(path)
