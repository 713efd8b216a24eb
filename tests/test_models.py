"""Quality of the fitted models on planted data, searches inside the fit, and stored models."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from demandloom.operators import forecast, tuning
from demandloom.operators.forecast import HurdleModel, HurdleSettings, TreeSettings
from demandloom.schema import STORE, numbered
from demandloom.session import cut
from test_weekly import rows

TARGETS = [numbered("quantity", 9), numbered("quantity", 10)]
LAGS = [numbered("quantity", k) for k in range(1, 9)]


@pytest.fixture(scope="module")
def planted(spark):
    """Stores that sell in the weeks after a promotion flag, twice their mean of the lags, and nothing otherwise."""
    rng = np.random.default_rng(21)
    lags = rng.integers(0, 30, (500, 8)).astype(float)
    flag = rng.integers(0, 2, 500)
    y = np.where(flag == 1, 2 * lags.mean(1) + lags[:, 7], 0.0)
    data = [(str(i), int(f), *map(float, r), round(float(v + rng.normal() * (v > 0)), 3), round(float(0.5 * v), 3)) for i, (f, r, v) in enumerate(zip(flag, lags, y))]
    kinds = ", ".join([f"{STORE} string", "premise int", *[f"{c} double" for c in LAGS + TARGETS]])
    frame = spark.createDataFrame(data, kinds)
    return cut(frame.where(F.col(STORE).cast("int") < 350)), cut(frame.where(F.col(STORE).cast("int") >= 350))


SETTINGS = HurdleSettings(regressor=TreeSettings(12, 4, 0.4, leaves=12, l2=0.4), classifier=TreeSettings(6, 2, 0.5, held_out=0.1, bins=48, l2=0.1), threshold=0.5)


def test_model_beats_yardsticks_and_mllib(planted):
    train, test = planted
    model = forecast.fit_hurdle(train, ["premise", *LAGS], TARGETS, SETTINGS)
    mae = {r.model: r.mae for r in forecast.score(model, test, TARGETS).where("horizon = 'mean'").collect()}
    assert mae["hurdle"] < 0.5 * min(mae["naive"], mae["zero"])
    vectors = VectorAssembler(inputCols=["premise", *LAGS], outputCol="x")
    theirs = []
    for target in TARGETS:
        other = GBTRegressor(featuresCol="x", labelCol=target, maxIter=12, maxDepth=4, stepSize=0.4, seed=1).fit(vectors.transform(train))
        theirs.append(other.transform(vectors.transform(test)).agg(F.avg(F.abs(F.col(target) - F.col("prediction")))).first()[0])
    assert mae["regressor"] <= 1.05 * np.mean(theirs)


def test_search_inside_the_fit_and_stored_model(spark, planted, tmp_path):
    train, test = planted
    search = tuning.Search({"trees": tuning.Range(4, 8, whole=True), "rate": tuning.Range(0.01, 0.8, log=True), "depth": tuning.Range(2, 3, whole=True)}, trials=3, folds=2)
    settings = HurdleSettings(regressor=search, classifier=search, threshold=0.5)
    model = forecast.fit_hurdle(train, ["premise", *LAGS], TARGETS, settings)
    best = {(r.model, r.parameter): r.value for r in model.best_parameters(spark).collect()}
    assert best["regressor", "rate"] == model.amounts.settings.rate and best["classifier", "trees"] == model.chances.settings.trees
    assert all(len(t) == model.amounts.settings.trees >= 4 for t in model.amounts.trees)
    trials = model.trials(spark).select("model", "trial", "best", "loss").distinct().collect()
    for name in ("regressor", "classifier"):
        assert min(r.loss for r in trials if r.model == name) == next(r.loss for r in trials if r.model == name and r.best)

    path = str(tmp_path / "model")
    model.save(spark, path)
    loaded = HurdleModel.load(spark.newSession(), path)
    columns = (STORE, "column_0", "column_1")
    assert rows(loaded.predict(test), *columns) == rows(model.predict(test), *columns)
    assert loaded.best_parameters(spark).count() == model.best_parameters(spark).count()
    assert model.predict(test).where("column_0 > 0").count() > 40


def test_searches_need_equal_folds(planted):
    with pytest.raises(ValueError):
        forecast.fit_hurdle(planted[0], LAGS, TARGETS, HurdleSettings(tuning.Search(folds=2), tuning.Search(folds=3)))


def test_halving_keeps_the_better_third_and_ends_flat_trials():
    """The rules of the search over losses known in advance, without Spark."""
    class Fake:
        calls: list = []

        def advance(self, ensembles, trees):
            self.calls.append((len(ensembles), trees))
            for e in ensembles:
                last = max(e.losses, default=-1)
                for n in range(last + 1, trees + 1):
                    e.losses[n] = curve(e.settings.depth, n)

    def curve(depth, n):
        return {2: 10 / (1 + n), 3: 5.0, 4: 9 / (1 + n)}[depth]  # 3 does not fall; 4 is best throughout

    class Inputs:
        @staticmethod
        def amounts(settings, targets, seed, fold):
            return forecast.Ensemble(settings, False, [0], [], targets, seed, fold)

    space = {"depth": tuning.Range(2, 4, whole=True), "rate": tuning.Range(0.1, 1.0), "trees": tuning.Range(20, 100, whole=True)}
    found = tuning.run_search(Fake(), Inputs, tuning.Search(space, trials=12, folds=2), False, 1)
    assert found.best.depth == 4 and found.best.trees == 100
    assert [n for _, n in Fake.calls] == [5, 20, 60, 100] and [k for k, _ in Fake.calls] == [24, 8, 4, 2]


def test_clustered_windows_are_built_once(spark, tmp_path, monkeypatch):
    from demandloom.catalog import queries
    from demandloom.catalog.views import Retail

    built = []
    monkeypatch.setattr(Retail, "clustered", lambda self, size, epsilon: None)
    monkeypatch.setattr(queries.weekly, "store_attributes", lambda stores: stores)
    monkeypatch.setattr(queries.windows, "store_windows", lambda *a, last_weeks, **o: built.append(list(last_weeks)) or spark.createDataFrame([(w,) for w in last_weeks], "week int"))
    monkeypatch.setattr(Retail, "positive", None)
    for weeks in ([52], [47, 52], [52], [47, 52]):
        frame = queries.clustered_windows(Retail(spark, str(tmp_path)), weeks)
        assert sorted(r.week for r in frame.collect()) == weeks
    assert built == [[52], [47, 52]]
