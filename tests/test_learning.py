import datetime
import math

import pytest
from conftest import SF_SMALL
from pyspark.ml.classification import LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from plumbline.operators import features, scoring, search, training
from plumbline.operators.registry import Registry, current_aliases, run_rows
from plumbline.operators.split import train_test
from plumbline.operators.training import Params, TrainingShape
from plumbline.plans import score
from plumbline.plans.retrain import EVENT_CATEGORIES, event_stages, retrain

NAMES = ["height", "width", "stem length", "stem width"]
REQUEST = '{"dataframe_split": {"columns": ["height", "width", "stem length", "stem width"], "data": [[4.9, 3.1, 1.5, 0.1], [6.5, 3.0, 5.8, 2.2]]}}'


@pytest.fixture(scope="module")
def flowers(spark):
    """Three classes around made-up centres, with the shape of the flower measurements."""
    centres = {0.0: (5.0, 3.4, 1.5, 0.2), 1.0: (5.9, 2.8, 4.3, 1.3), 2.0: (6.6, 3.0, 5.6, 2.0)}
    rows = []
    for label, centre in centres.items():
        for i in range(60):
            rows.append((len(rows), label, *(c + 0.15 * math.sin(i * (j + 3)) for j, c in enumerate(centre))))
    columns = ", ".join(f"`{n}` double" for n in NAMES)
    return spark.createDataFrame(rows, f"id long, label double, {columns}").coalesce(1)


@pytest.fixture(scope="module")
def prepared(flowers):
    before = features.fit_features([features.assembler(NAMES)], flowers)
    return before, *train_test(before.transform(flowers).select("id", "features", "label"), "id")


def test_solvers_choose_how_classes_are_fitted(spark):
    assert isinstance(training.classifier(Params(0.5, "liblinear"), TrainingShape(100, 3)), OneVsRest)
    joint = training.classifier(Params(0.5, "lbfgs"), TrainingShape(100, 3))
    assert joint.getRegParam() == pytest.approx(1 / 50)
    assert not joint.getStandardization()
    assert not isinstance(training.classifier(Params(0.5, "liblinear"), TrainingShape(100, 2)), OneVsRest)
    with pytest.raises(ValueError):
        training.classifier(Params(0.5, "newton"), TrainingShape(100, 2))


def test_penalty_is_the_textbook_objective(spark):
    """At the optimum, C times the loss gradient balances the weights."""
    points = [(-2.0, 0.0), (-1.0, 0.0), (-0.5, 1.0), (0.4, 0.0), (1.0, 1.0), (2.5, 1.0)]
    df = spark.createDataFrame([(Vectors.dense(x), y) for x, y in points], ["features", "label"])
    model = training.classifier(Params(0.3, "lbfgs"), TrainingShape(6, 2)).fit(df)
    w, b = model.coefficients[0], model.intercept
    residual = [1 / (1 + math.exp(-(w * x + b))) - y for x, y in points]
    assert 0.3 * sum(r * x for r, (x, _) in zip(residual, points)) + w == pytest.approx(0, abs=1e-4)
    assert sum(residual) == pytest.approx(0, abs=1e-4)


def test_model_survives_storage_and_answers_requests(spark, flowers, prepared, tmp_path):
    before, train_rows, test_rows = prepared
    made = training.train(train_rows, test_rows, Params(0.5, "lbfgs"), before)
    assert made.accuracy > 0.9
    training.save_model(made.model, str(tmp_path / "model"))
    model = training.load_model(str(tmp_path / "model"))
    requests = spark.createDataFrame([(REQUEST,)], "request string")
    rows = scoring.expand_requests(requests, "request", NAMES)
    answers = scoring.score(model, rows).orderBy("row_no").collect()
    assert [r.prediction for r in answers] == [0.0, 2.0]


def test_one_against_the_rest_survives_storage(flowers, prepared, tmp_path):
    before, train_rows, test_rows = prepared
    made = training.train(train_rows, test_rows, Params(0.5, "liblinear"), before)
    assert isinstance(made.model.stages[-1], OneVsRestModel)
    training.save_model(made.model, str(tmp_path / "model"))
    again = training.load_model(str(tmp_path / "model"))
    assert training.accuracy(again.transform(flowers)) > 0.8


def test_trials_share_one_split_and_match_single_fits(prepared):
    before, train_rows, test_rows = prepared
    drawn = [Params(0.05, "liblinear"), Params(0.05, "saga"), Params(1e-4, "lbfgs")]
    trials = search.run_trials(train_rows, test_rows, drawn, parallelism=2)
    rows = trials.orderBy("trial_id").collect()
    assert [(r.c, r.solver) for r in rows] == [(p.c, p.solver) for p in drawn]
    for row, params in zip(rows, drawn):
        assert row.accuracy == pytest.approx(training.train(train_rows, test_rows, params).accuracy)


def test_fits_go_side_by_side_over_few_partitions(prepared, monkeypatch):
    """A pass costs a task per partition, and there are hundreds: partitions go by the features, not by the texts; classes don't wait for each other."""
    _, train_rows, test_rows = prepared
    seen = []

    def watched(kind, at_once):
        fit = kind._fit
        monkeypatch.setattr(kind, "_fit", lambda self, rows: seen.append((rows.rdd.getNumPartitions(), at_once(self))) or fit(self, rows))

    watched(OneVsRest, lambda one: one.getParallelism())
    watched(LogisticRegression, lambda one: 0)
    search.run_trials(train_rows.repartition(40), test_rows, [Params(0.05, "liblinear"), Params(0.05, "lbfgs")]).collect()
    assert all(parts < 40 for parts, _ in seen)
    assert sorted(at_once for _, at_once in seen) == [0, 0, 0, 0, 3]


@pytest.mark.parametrize("room, solvers, classes, expected", [
    (1, ["liblinear", "lbfgs"], 4, (1, 1)),
    (2, ["liblinear", "lbfgs"], 4, (2, 1)),
    (4, ["liblinear", "lbfgs"], 4, (2, 3)),
    (99, ["liblinear", "lbfgs"], 4, (2, 4)),
    (4, ["liblinear"] * 3, 4, (3, 1)),
    (99, ["lbfgs"] * 9, 4, (4, 1)),
    (99, ["liblinear"], 2, (1, 1)),
])
def test_no_more_fits_at_once_than_memory_has_room_for(room, solvers, classes, expected):
    trials = [Params(0.1, solver) for solver in solvers]
    assert search.side_by_side(trials, TrainingShape(100, classes), room, 4) == expected


def test_draws_are_seeded_and_in_range():
    drawn = search.draw()
    assert len(drawn) == 20 and drawn == search.draw()
    assert all(1e-4 <= p.c <= 1e-1 for p in drawn)
    assert {p.solver for p in search.draw(200)} == {"liblinear", "saga", "lbfgs"}
    logs = [math.log10(p.c) for p in search.draw(2000, seed=5)]
    assert sum(logs) / 2000 == pytest.approx(-2.5, abs=0.1)


def test_best_trial_is_the_first_of_the_most_accurate(spark):
    rows = [(0, 0.1, "saga", 0.8), (1, 0.2, "lbfgs", 0.9), (2, 0.3, "saga", 0.9), (3, 0.4, "saga", None)]
    trials = spark.createDataFrame(rows, "trial_id int, c double, solver string, accuracy double")
    assert search.best_params(trials) == Params(0.2, "lbfgs")


def test_any_number_of_categories_trains_and_scores(spark, tmp_path):
    rows = spark.range(150_000).selectExpr(
        "id", "cast(id as string) as user_id", "if(id % 3 = 0, '/a', '/b') as page",
        "if(id % 2 = 0, 'click', 'view') as event_type", "cast(id % 2 as double) * 50 as purchase_value",
    )
    models = Registry(spark, str(tmp_path))
    made = retrain(
        rows, event_stages(), "id", models, "m", "Live",
        categories=EVENT_CATEGORIES, example=("user_id", "page", "purchase_value"), n_trials=1,
    )
    new = spark.createDataFrame([(1, "nobody", "/c", 50.0), (2, "8", "/a", 0.0)], "id int, user_id string, page string, purchase_value double")
    scored = score.score_rows(new, models, "m", "Live").collect()
    assert sorted(r.id for r in scored) == [1, 2] and {r.user_id_index for r in scored if r.id == 1} == {150_000.0}
    uri = models.uri("m", "Live")
    assert uri.endswith(made.run_id) and spark.read.parquet(f"{uri}-example").count() == 5
    with pytest.raises(LookupError):
        score.load(models, "m", "Nowhere")


@pytest.mark.parametrize("share, least, most", [(0, 0, 0), (1, 2000, 2000), (1.0, 2000, 2000), (0.99999, 1998, 2000), (0.3, 500, 700)])
def test_shares_of_keys(spark, share, least, most):
    from plumbline.operators.split import sampled

    assert least <= sampled(spark.range(2000), "id", share).count() <= most


@pytest.mark.parametrize("share", [-0.1, 1.2, float("nan")])
def test_shares_outside_zero_and_one_are_refused(spark, share):
    from plumbline.operators.split import sampled

    with pytest.raises(ValueError, match="between 0 and 1"):
        sampled(spark.range(5), "id", share)


def test_unseen_categories_are_kept(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    model = features.category_indexers(["c"])[0].fit(df)
    seen = spark.createDataFrame([("b",), ("zzz",)], "c string")
    assert [r.c_index for r in model.transform(seen).collect()] == [1.0, 2.0]


def test_vectors_from_arrays(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    row = features.vector_of(df, "embedding").select("embedding", "features").first()
    assert list(row.features) == [float(v) for v in row.embedding]


def test_requests_in_other_shapes(spark):
    payloads = [
        '{"dataframe_split": {"columns": ["b", "a"], "data": [[1, 2], [3]]}}',
        "not json",
        '{"dataframe_split": {"columns": ["a"], "data": []}}',
        None,
    ]
    df = spark.createDataFrame(list(enumerate(payloads)), "id int, request string")
    rows = scoring.expand_requests(df, "request", ["a", "b", "c"], ["id"]).orderBy("id", "row_no").collect()
    assert [tuple(r) for r in rows] == [(0, 0, 2.0, 1.0, None), (0, 1, None, 3.0, None)]


def test_scoring_a_stream(spark, prepared, tmp_path):
    before, train_rows, test_rows = prepared
    model = training.train(train_rows, test_rows, Params(0.5, "lbfgs"), before).model
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(REQUEST + "\n")
    stream = spark.readStream.format("text").load(str(tmp_path / "in"))
    scored = scoring.score(model, scoring.expand_requests(stream, "value", NAMES)).select("row_no", "prediction")
    query = (
        scored.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("row_no").collect()
    assert [r.prediction for r in rows] == [0.0, 2.0]


def test_registry(spark, tmp_path):
    models = Registry(spark, str(tmp_path / "registry"))
    day = [datetime.datetime(2024, 1, d) for d in range(1, 6)]
    assert models.versions.count() == 0 and models.uri("m", "Staging") is None
    assert models.register("m", "r1", "uri1", day[0]) == 1
    assert models.register("m", "r2", "uri2", day[1]) == 2
    assert models.register("other", "r3", "uri3", day[1]) == 1
    models.point("m", "Staging", 2, day[2])
    models.point("m", "Production", 1, day[2])
    assert (models.uri("m", "Staging"), models.uri("m", "Production")) == ("uri2", "uri1")
    models.point("m", "Staging", 1, day[3])
    assert models.uri("m", "Staging") == "uri1"
    assert current_aliases(models.aliases).count() == 2
    models.log_run(run_rows(spark, "r1", {"C": 0.5}, {"accuracy": 0.9}))
    assert sorted(tuple(r) for r in models.runs.collect()) == [
        ("r1", "metric", "accuracy", "0.9"), ("r1", "param", "C", "0.5"),
    ]


def test_retraining_end_to_end(spark, flowers, tmp_path):
    models = Registry(spark, str(tmp_path / "registry"))
    for expected_version in (1, 2):
        made = retrain(
            flowers, [features.assembler(NAMES)], "id", models, "flowers", "Staging", n_trials=3, parallelism=3,
            at=datetime.datetime(2024, 1, expected_version),
        )
        assert made.version == expected_version
    logged = models.runs.where(F.col("run_id") == made.run_id).collect()
    assert {(r.kind, r.key) for r in logged} == {("param", "C"), ("param", "solver"), ("metric", "accuracy")}
    assert models.runs.where(F.col("run_id").startswith(made.search_id)).count() == 9
    model = training.load_model(models.uri("flowers", "Staging"))
    assert training.accuracy(model.transform(flowers)) > 0.6
    example = training.input_example(flowers, "id", NAMES).collect()
    assert len(example) == 5 and example[0] == flowers.orderBy("id").select(*NAMES).first()


def test_event_model_scores_rows_without_labels(spark, tmp_path):
    from plumbline.catalog.base import staged_v1, table

    staged = staged_v1(table(spark, SF_SMALL, "events")).fillna(0.0, ["purchase_value"])
    models = Registry(spark, str(tmp_path / "registry"))
    made = retrain(
        staged, event_stages(), "event_id", models, "events", "Staging",
        categories=EVENT_CATEGORIES, n_trials=2, parallelism=2,
    )
    scored = score.score_rows(staged.drop("event_type"), models, "events", "Staging")
    assert scored.where("prediction between 0 and 4").count() == 1000
    assert 0 <= made.accuracy <= 1
