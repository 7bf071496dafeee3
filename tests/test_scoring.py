import json

import pytest
from conftest import SF_SMALL
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from plumbline.catalog.base import staged_v1, table
from plumbline.operators import features, scoring, training
from plumbline.operators.registry import Registry
from plumbline.operators.scoring import Input
from plumbline.plans import retrain, score
from test_plans import T1, T2

INPUTS = [Input("a"), Input("b", fill="1.5"), Input("c", "string", required=False)]


def request(columns, *rows):
    return json.dumps({"dataframe_split": {"columns": columns, "data": rows}})


def read(spark, *bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    rows = scoring.read_requests(df, "body", INPUTS, ["k"]).orderBy("k", "row_no").collect()
    return [tuple(r) for r in rows]


def test_rows_are_found_by_name_and_faults_have_reasons(spark):
    got = read(
        spark,
        request(["c", "b", "a", "z"], ["x", 2, 1, None], [None, None, "3.5", []]),
        request(["a", "b"], [1, 2]),
        request(["a", "b", "c"], [1, 2], None, [1, 2, 3, 4], [None, 2, "x"], ["word", 2, "x"], ["NaN", 2, "x"], [5, "inf", "x"]),
        request(["a", "b", "c"]),
        request(["a", "a", "b", "c"], [1, 1, 2, "x"]),
        "no json",
        None,
        "{}",
        '{"dataframe_split": {"columns": ["a", "b", "c"], "data": 7}}',
        '{"dataframe_split": {"data": [[1]]}}',
    )
    assert got == [
        (0, 0, None, 1.0, 2.0, "x"),
        (0, 1, None, 3.5, None, None),
        (1, None, "missing_feature", None, None, None),
        (2, 0, "wrong_length", 1.0, 2.0, None),
        (2, 1, "wrong_length", None, None, None),
        (2, 2, "wrong_length", 1.0, 2.0, "3"),
        (2, 3, "no_value", None, 2.0, "x"),
        (2, 4, "no_value", None, 2.0, "x"),
        (2, 5, "no_value", None, 2.0, "x"),
        (2, 6, None, 5.0, None, "x"),
        (3, None, "no_rows", None, None, None),
        (4, None, "repeated_feature", None, None, None),
        *[(k, None, "unreadable", None, None, None) for k in range(5, 10)],
    ]


def stored(spark, root, version=1, factor=1.0, alias=True):
    """A model that adds up its numbers and the index of its category."""
    models = Registry(spark, root)
    uri = f"{root}/models/m/{version}"
    seen = spark.createDataFrame([("x",), ("x",), ("y",)], "c string")
    features.category_table(seen, ["c"]).write.parquet(training.categories_path(uri))
    scoring.input_rows(spark, INPUTS).write.parquet(training.inputs_path(uri))
    rule = f"SELECT *, {factor}D * (a + b) + 100 * c_index AS prediction FROM __THIS__"
    training.save_model(PipelineModel([features.assembler(["a", "b", "c_index"]), SQLTransformer(statement=rule)]), uri)
    at = T1 if version == 1 else T2
    models.point("m", "Live", models.register("m", str(version), uri, at), at)
    return models


def test_rows_come_back_as_they_were(spark, tmp_path):
    models = stored(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [(1, None, "x", 9.0, None, "r"), (2, 4.0, None, None, 7.5, None)],
        "a int, b double, c string, features double, `x.y` double, kept_row string",
    )
    got = sorted(map(tuple, score.score_rows(rows, models, "m", "Live").collect()))
    assert got == [(1, None, "x", 9.0, None, "r", 2.5), (2, 4.0, None, None, 7.5, None, 206.0)]
    with pytest.raises(ValueError, match="prediction"):
        score.score_rows(rows.withColumn("Prediction", F.lit(0)), models, "m", "Live")


def test_a_missing_feature_stops_only_its_row(spark, tmp_path):
    models = stored(spark, str(tmp_path))
    bodies = [(1, request(["a", "b", "c"], [1, 2, "x"], [None, 2, "x"], [1, None, "new"])), (2, request(["b"], [1]))]
    df = spark.createDataFrame(bodies, "k int, body string")
    good, bad = score.score_requests(df, "body", [], ["k"], models, "m", "Live")
    assert sorted((r.k, r.row_no, r.prediction) for r in good.collect()) == [(1, 0, 3.0), (1, 2, 202.5)]
    assert sorted((r.k, r.row_no or 0, r.problem) for r in bad.collect()) == [(1, 1, "no_value"), (2, 0, "missing_feature")]


def test_a_stream_goes_on_where_it_stopped_and_takes_the_promoted_model(spark, tmp_path):
    registry, replay = str(tmp_path / "registry"), tmp_path / "replay"
    out, bad, log = (str(tmp_path / n) for n in ("out", "bad", "log"))
    models = stored(spark, registry)
    replay.mkdir()
    run = ["--replay", str(replay), "--registry", registry, "--name", "m", "--alias", "Live", "--output", out, "--rejected", bad, "--checkpoint", log, "--once"]
    (replay / "1.txt").write_text(request(["a", "b", "c"], [1, 2, "y"]) + "\nno json\n")
    score.main(run)
    first = spark.read.parquet(out).collect()
    assert [(r.a, r.prediction, r.batch_id) for r in first] == [(1.0, 103.0, 0)]
    score.main(run)  # nothing new
    assert spark.read.parquet(out).count() == 1
    stored(spark, registry, 2, 10.0)
    (replay / "2.txt").write_text(request(["a", "b", "c"], [1, 2, "y"], [None, 2, "y"]) + "\n")
    score.main(run)
    assert sorted((r.batch_id, r.prediction) for r in spark.read.parquet(out).collect()) == [(0, 103.0), (1, 130.0)]
    assert sorted((r.batch_id, r.problem) for r in spark.read.parquet(bad).collect()) == [(0, "unreadable"), (1, "no_value")]
    assert models.aliases.count() == 2


def test_a_repeated_batch_replaces_what_it_left(spark, tmp_path):
    from plumbline.streaming.scoring import start_scoring

    replay = tmp_path / "replay"
    replay.mkdir()
    (replay / "1.txt").write_text("a\nb\n")
    out, bad = (str(tmp_path / n) for n in ("out", "bad"))
    failing = [True]

    def parts(batch):
        if failing[0]:  # the predictions are written, the rejected rows fail
            failing[0] = False
            return batch, batch.select(F.raise_error(F.lit("lost")).cast("string").alias("value"))
        return batch, batch.limit(0)

    stream = spark.readStream.text(str(replay))
    with pytest.raises(PySparkException):
        start_scoring(stream, parts, out, bad, str(tmp_path / "log"), None).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    start_scoring(stream, parts, out, bad, str(tmp_path / "log"), None).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_the_job_scores_requests_and_rows_of_a_table(spark, tmp_path):
    registry, out, bad = (str(tmp_path / n) for n in ("registry", "out", "bad"))
    staged = staged_v1(table(spark, SF_SMALL, "events")).withColumn("n", F.lit(None).cast("int"))
    staged = staged.withColumn("purchase_value", F.when(F.col("event_id") % 2 == 0, F.col("purchase_value")))
    staged.write.parquet(str(tmp_path / "staged"))
    retrain.main(["--table", str(tmp_path / "staged"), "--key", "event_id", "--registry", registry, "--trials", "1"])
    inputs = score.load(Registry(spark, registry), "event_type_classifier", "Staging").inputs
    assert [(i.name, i.kind, i.fill, i.required) for i in inputs] == [
        ("user_id", "string", None, False), ("page", "string", None, False), ("purchase_value", "double", "0.0", True),
    ]
    score.main(["--table", str(tmp_path / "staged"), "--registry", registry, "--output", out])
    scored = spark.read.parquet(out)
    assert scored.drop("prediction").exceptAll(staged).isEmpty() and staged.exceptAll(scored.drop("prediction")).isEmpty()

    asked = spark.createDataFrame([(request(["page", "user_id", "purchase_value"], ["/home", "1", None], ["?", None, 3]),), ("?",)], "body string")
    asked.write.parquet(str(tmp_path / "asked"))
    score.main(["--table", str(tmp_path / "asked"), "--requests", "body", "--registry", registry, "--output", out + "2", "--rejected", bad])
    assert spark.read.parquet(out + "2").where("prediction IS NOT NULL").count() == 2
    assert [r.problem for r in spark.read.parquet(bad).collect()] == ["unreadable"]
    with pytest.raises(SystemExit):
        score.main(["--table", "x", "--requests", "body", "--registry", registry, "--output", out])


def test_rows_without_a_needed_value_go_apart(spark):
    rows = spark.createDataFrame([(1.0, None, None), (None, 1.0, "x"), (float("nan"), 1.0, "x")], "a double, b double, c string")
    good, bad = scoring.split_usable(rows, INPUTS)
    assert good.count() == 1 and [r.problem for r in bad.collect()] == ["no_value"] * 2
