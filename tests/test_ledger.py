import datetime
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from plumbline.operators import registry, search
from plumbline.operators.registry import Registry, claim
from plumbline.operators.training import Params

AT = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(Vectors.dense([float(k % 7), float(k % 5)]), float((k % 7) > 3)) for k in range(120)]
    df = spark.createDataFrame(rows, ["features", "label"])
    return df.limit(90), df.limit(30)


def test_a_search_goes_on_where_it_stopped(spark, parts, tmp_path, monkeypatch):
    train, test = parts
    trials = [Params(c, "lbfgs") for c in (0.01, 0.1, 1.0, 10.0, 100.0)]
    ledger = search.Ledger(spark, str(tmp_path / "ledger"))
    fitted, real = [], search.classifier

    def counted(params, shape):
        fitted.append(params.c)
        if len(fitted) == 4:
            raise RuntimeError("the driver is gone")
        return real(params, shape)

    monkeypatch.setattr(search, "classifier", counted)
    with pytest.raises(RuntimeError, match="gone"):
        search.continue_trials(train, test, trials, ledger, "s", parallelism=1)
    done = {r.trial_id for r in ledger.trials("s").collect()}
    assert 3 <= len(done) < 5
    before = len(fitted)
    again = search.Ledger(spark, str(tmp_path / "ledger"))
    rows = search.continue_trials(train, test, trials, again, "s", parallelism=2).orderBy("trial_id").collect()
    assert sorted(fitted[before:]) == sorted(t.c for at, t in enumerate(trials) if at not in done)
    assert [(r.trial_id, r.c, r.solver) for r in rows] == [(at, t.c, "lbfgs") for at, t in enumerate(trials)]
    whole = search.run_trials(train, test, trials).orderBy("trial_id").collect()
    assert [r.accuracy for r in rows] == pytest.approx([r.accuracy for r in whole])
    before = len(fitted)
    search.continue_trials(train, test, trials, again, "s")
    assert len(fitted) == before
    with pytest.raises(ValueError, match="other parameters"):
        search.continue_trials(train, test, trials[::-1], again, "s")


def test_trials_finished_twice_count_once(spark, tmp_path):
    ledger = search.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.trials("s").count() == 0
    for found in (0.5, 0.9):
        ledger.add("s", 0, Params(1.0, "saga"), found)
    ledger.add("s", 1, Params(2.0, "saga"), None)
    ledger.add("t", 0, Params(3.0, "saga"), 0.5)
    ledger.add("t", 1, Params(4.0, "saga"), 0.5)
    assert sorted(map(tuple, ledger.trials("s").collect())) == [(0, 1.0, "saga", 0.5), (1, 2.0, "saga", None)]
    assert sorted(map(tuple, search.best_trials(search.finished(ledger.rows)).collect())) == [("s", 0, 1.0, "saga", 0.5), ("t", 0, 3.0, "saga", 0.5)]
    rows = registry.ledger_rows(search.finished(ledger.rows))
    assert rows.where("run_id = 's-1'").count() == 2 and rows.count() == 11


def test_writers_side_by_side_get_versions_of_their_own(spark, tmp_path):
    root = str(tmp_path / "registry")

    def register(k):
        return Registry(spark, root).register("a model/with a slash", f"r{k}", f"uri{k}", AT)

    with ThreadPool(8) as pool:
        assert sorted(pool.map(register, range(8))) == list(range(1, 9))
    models = Registry(spark, root)
    assert sorted((r.version, r.name) for r in models.versions.collect()) == [(v, "a model/with a slash") for v in range(1, 9)]
    with ThreadPool(4) as pool:
        pool.map(lambda k: models.point("a model/with a slash", f"alias{k % 2}", k + 1, AT + datetime.timedelta(hours=k)), range(4))
    found = {r.alias: r.version for r in registry.current_aliases(models.aliases).collect()}
    assert found == {"alias0": 3, "alias1": 4}


def test_a_lost_claim_leaves_a_gap(spark, tmp_path):
    models = Registry(spark, str(tmp_path / "registry"))
    assert models.register("m", "r1", "u1", AT) == 1
    assert claim(spark, f"{models.root}/claims/m/2") and not claim(spark, f"{models.root}/claims/m/2")
    assert claim(spark, f"file://{models.root}/claims/m/7") and not claim(spark, f"{models.root}/claims/m/7")
    assert models.register("m", "r3", "u3", AT) == 3
    assert [r.version for r in models.versions.orderBy("version").collect()] == [1, 3]
    assert models.runs.where(F.lit(True)).count() == 0
