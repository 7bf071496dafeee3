import datetime

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from plumbline.catalog.base import staged_v1, staged_v2, table
from plumbline.operators.drift import DriftRules
from plumbline.operators.definitions import Checkpoint, Definitions
from plumbline.operators.expectations import InSet, NotNull
from plumbline.operators.suite import COUNTS, USER_EVENTS_SUITE, Run, Suite
from plumbline.plans import drift, ingest, page, retrain, score, stage, validate
from plumbline.plans.drift import measure_drift
from plumbline.sources.tables import append_rows, as_of, load_table, read_log

T1, T2 = datetime.datetime(2024, 3, 1, 8), datetime.datetime(2024, 3, 2, 8)


def test_validation_keeps_history_and_pushes_a_gauge(spark, tmp_path):
    staged = staged_v2(table(spark, SF_SMALL, "events"))
    places = [str(tmp_path / name) for name in ("results", "metrics")]
    for at in (T1, T2):
        verdict = validate.validate([(staged, USER_EVENTS_SUITE)], "stg", Run.starting(at), *places, level=COUNTS)
        assert verdict is False
    history = spark.read.parquet(places[0])
    assert history.count() == 22 and history.select("run_date").distinct().count() == 2
    assert as_of(history, "run_time", T1).count() == 11
    gauges = spark.read.parquet(places[1]).collect()
    assert [(g.name, g.value) for g in gauges] == [("data_valition_result", 0.0)] * 2


def test_drift_keeps_history_and_pushes_gauges(spark, tmp_path):
    staged = staged_v1(table(spark, SF_SMALL, "events"))
    places = [str(tmp_path / name) for name in ("report", "metrics")]
    columns = ["user_id", "event_type", "page", "purchase_value"]
    for at in (T1, T2):
        found = measure_drift(staged, ["ts", "event_id"], columns, at, *places)
    assert found.n_columns == 4
    assert spark.read.parquet(places[0] + "/columns").count() == 8
    assert spark.read.parquet(places[0] + "/summary").count() == 2
    values = {(g.run_time, g.name): g.value for g in spark.read.parquet(places[1]).collect()}
    assert values[T2, "model_data_drift_score"] == found.drifted_share
    assert values[T2, "model_data_drift_detected"] == found.drifted_count


def test_failed_drift_run_appends_nothing(spark, tmp_path):
    staged = staged_v1(table(spark, SF_SMALL, "events"))
    broken = staged.withColumn("purchase_value", F.raise_error(F.lit("gone")).cast("double"))
    places = [str(tmp_path / name) for name in ("report", "metrics")]
    with pytest.raises(Exception, match="gone"):
        measure_drift(broken, ["ts"], ["purchase_value"], T1, *places, rules=DriftRules())
    assert not (tmp_path / "report").exists() and not (tmp_path / "metrics").exists()


def test_catalog_tables(spark, tmp_path):
    table(spark, SF_SMALL, "nation").createOrReplaceTempView("nations_here")
    assert load_table(spark, "nations_here").count() == 25
    log = str(tmp_path / "log")
    assert read_log(spark, log, "a int").count() == 0
    append_rows(spark.createDataFrame([(1,)], "a int"), log)
    append_rows(spark.createDataFrame([(2,)], "a int"), log)
    assert read_log(spark, log, "a int").count() == 2
    with pytest.raises(Exception, match="(?i)delta"):
        load_table(spark, log, version=3)


def test_job_mains(spark, tmp_path, capsys):
    replay, bronze, log = (str(tmp_path / n) for n in ("replay", "bronze", "progress"))
    line = '{"user_id":"u","event_type":"click","timestamp":"2024-01-01T00:00:07Z","page":"/home","value":9}'
    spark.createDataFrame([(line,)] * 3, "value string").write.text(replay)
    ingest.main(["--replay", replay, "--path", bronze, "--checkpoint", log, "--once"])
    assert spark.read.parquet(bronze).count() == 3

    staged = str(tmp_path / "staged")
    staged_v1(table(spark, SF_SMALL, "events")).write.parquet(staged)
    results, metrics, report = (str(tmp_path / n) for n in ("results", "metrics", "report"))
    validate.main(["--table", staged, "--results", results, "--metrics", metrics])
    assert "success=False" in capsys.readouterr().out
    drift.main([
        "--table", staged, "--order", "ts", "event_id", "--report", report, "--metrics", metrics, "--persist",
        "--sample", "0.9", "--sample-key", "event_id",
    ])
    assert spark.read.parquet(metrics).count() == 3
    assert {r.column for r in spark.read.parquet(report + "/columns").collect()} == {
        "user_id", "event_type", "page", "purchase_value",
    }
    registry = str(tmp_path / "registry")
    retrain.main(["--table", staged, "--key", "event_id", "--registry", registry, "--trials", "1"])
    assert spark.read.parquet(registry + "/model_version").count() == 1
    predictions = str(tmp_path / "predictions")
    score.main(["--table", staged, "--registry", registry, "--keep", "event_id", "--output", predictions])
    scored = spark.read.parquet(predictions)
    assert scored.columns == ["event_id", "prediction"] and scored.count() == spark.read.parquet(staged).count()


def test_from_replayed_files_to_the_page(spark, tmp_path):
    """All jobs after each other, each on what the last one wrote."""
    at = {n: str(tmp_path / n) for n in ("replay", "bronze", "progress", "staged", "results", "metrics", "report", "registry", "out", "bad", "page", "definitions")}
    line = '{{"user_id":"u{0}","event_type":"{1}","timestamp":"2024-01-01T00:{2:02d}:07Z","page":"/home","value":{0}}}'
    kinds = ("click", "purchase", "page_view", "add_to_cart")
    lines = [(line.format(k, kinds[k % 4], k % 60),) for k in range(240)]
    spark.createDataFrame(lines, "value string").repartition(4).write.text(at["replay"])
    ingest.main(["--replay", at["replay"], "--path", at["bronze"], "--checkpoint", at["progress"], "--once", "--batches", "--rows-per-file", "50", "--max-files-per-trigger", "2"])
    assert load_table(spark, at["bronze"], version=0).count() < load_table(spark, at["bronze"], version=1).count() == 240

    stage.main(["--table", at["bronze"], "--output", at["staged"], "--key", "event_key", "--minutes", "2024-01-01-00-00", "2024-01-01-00-49"])
    staged = spark.read.parquet(at["staged"])
    assert staged.columns == ["user_id", "event_type", "page", "ts", "purchase_value", "event_key"]
    assert staged.count() == staged.select("event_key").distinct().count() == 200

    validate.main(["--table", at["staged"], "--results", at["results"], "--metrics", at["metrics"]])
    kept = Definitions(spark, at["definitions"])
    kept.add_or_update(Suite("own", (NotNull("ts"), InSet("event_type", values=kinds))))
    kept.add_or_update(Checkpoint("nightly", ((at["staged"], "own"),), COUNTS))
    validate.main(["--definitions", at["definitions"], "--checkpoint", "nightly", "--results", at["results"] + "2", "--metrics", at["metrics"]])
    assert [r.success for r in spark.read.parquet(at["results"] + "2").collect()] == [True, True]
    with pytest.raises(SystemExit):
        validate.main(["--checkpoint", "nightly", "--results", at["results"], "--metrics", at["metrics"]])

    columns = ["--columns", "event_type", "purchase_value"]
    drift.main(["--table", at["staged"], "--report", at["report"], "--metrics", at["metrics"], "--split-time", "2024-01-01T00:20:00", "--exact-pairs", "100000", *columns])
    sides = {(r.n_ref, r.n_cur) for r in spark.read.parquet(at["report"] + "/columns").collect()}
    assert sides == {(80, 120)}

    retrain.main(["--table", at["staged"], "--key", "event_key", "--registry", at["registry"], "--trials", "2", "--search-id", "s"])
    score.main(["--table", at["staged"], "--registry", at["registry"], "--output", at["out"], "--rejected", at["bad"]])
    assert spark.read.parquet(at["out"]).count() == 200 and spark.read.parquet(at["bad"]).count() == 0
    assert spark.read.parquet(at["registry"] + "/ledger").count() == 2

    page.main(["--metrics", at["metrics"], "--page", at["page"]])
    shown = [r.value for r in spark.read.text(at["page"]).collect()]
    assert any(x.startswith("data_valition_result{") for x in shown) and any(x.startswith("model_data_drift_score{") for x in shown)
    stage.main(["--table", at["bronze"], "--version", "0", "--output", at["staged"] + "2", "--append"])
    assert load_table(spark, at["staged"] + "2", version=0).count() == load_table(spark, at["bronze"], version=0).count()
