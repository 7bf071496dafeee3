import datetime

from plumbline.operators.gauges import drift_gauges, exposition, latest_push, validation_gauge, write_page
from plumbline.schemas import METRIC

T1, T2 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)


def metrics(spark, *rows):
    return spark.createDataFrame(list(rows), METRIC)


def page(lines):
    return [r.line for r in lines.orderBy("name", "part", "line").collect()]


def test_validation_gauge(spark):
    verdicts = spark.createDataFrame([(T1, True), (T2, False)], "run_time timestamp, success boolean")
    rows = validation_gauge(verdicts, "stg_user_events_v2").orderBy("run_time").collect()
    assert [(r.job, r.name, r.labels, r.value) for r in rows] == [
        ("gx_data_validation", "data_valition_result", {"table_name": "stg_user_events_v2"}, 1.0),
        ("gx_data_validation", "data_valition_result", {"table_name": "stg_user_events_v2"}, 0.0),
    ]


def test_drift_gauges(spark):
    summary = spark.createDataFrame([(4, 1, 0.25)], "n_columns int, drifted_count int, drifted_share double")
    rows = {r.name: r for r in drift_gauges(summary, "stg_user_events_v1", T1).collect()}
    assert rows["model_data_drift_score"].value == 0.25
    assert rows["model_data_drift_detected"].value == 1.0
    assert rows["model_data_drift_score"].labels == {"model_name": "stg_user_events_v1"}
    assert {r.job for r in rows.values()} == {"evidently_batch_validation"}


def test_a_push_replaces_all_the_job_pushed_before(spark):
    log = metrics(
        spark,
        (T1, "a", "old", "h", {}, 1.0),
        (T1, "a", "both", "h", {}, 1.0),
        (T2, "a", "both", "h", {"k": "v"}, 2.0),
        (T2, "a", "new", "h", {}, 3.0),
        (T1, "b", "other", "h", {}, 4.0),
    )
    kept = sorted((r.job, r.name, r.value) for r in latest_push(log).collect())
    assert kept == [("a", "both", 2.0), ("a", "new", 3.0), ("b", "other", 4.0)]


def test_exposition_text(spark, tmp_path):
    rows = metrics(
        spark,
        (T1, "j", "g", 'say "hi"\\\n', {"z": 'q"\\\n', "a": "1"}, 0.5),
        (T1, "j", "g", 'say "hi"\\\n', None, float("inf")),
        (T1, "j", "b", None, {"job": "mine"}, float("nan")),
    )
    assert page(exposition(rows)) == [
        "# HELP b ", "# TYPE b gauge", 'b{job="j"} NaN',
        '# HELP g say "hi"\\\\\\n', "# TYPE g gauge",
        'g{a="1",job="j",z="q\\"\\\\\\n"} 0.5', 'g{job="j"} +Inf',
    ]
    assert page(exposition(rows, with_job=False))[-2:] == ["g +Inf", 'g{a="1",z="q\\"\\\\\\n"} 0.5']
    write_page(exposition(rows), str(tmp_path / "page"))
    files = sorted((tmp_path / "page").glob("part-*.txt"))
    assert "".join(f.read_text() for f in files).splitlines() == page(exposition(rows))
