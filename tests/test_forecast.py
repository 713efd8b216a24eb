from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from demandloom.catalog.views import Retail
from demandloom.operators import forecast, metrics, tuning, windows
from demandloom.plans import weekly_plan
from demandloom.schema import STORE
from test_weekly import rows

QUICK = forecast.HurdleSettings(
    regressor=forecast.TreeSettings(3, 3, 1.0, 0.4), classifier=forecast.TreeSettings(3, 2, 1.0, 0.3), threshold=0.5
)
NAMES = ("quantity", "net_value", "premise")


def test_threshold_bounds():
    for bad in (0, -1, 1.1):
        with pytest.raises(ValueError):
            forecast.HurdleSettings(threshold=bad)


def test_threshold_one_keeps_the_largest_chance(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 0.2, 5.0, 6.0), ("b", 0.9, 0.3, 7.0, 8.0), ("c", 0.4, 0.5, 9.0, 1.0)],
        f"{STORE} string, c0 double, c1 double, a0 double, a1 double",
    )
    top = forecast.gate(df, ["c0", "c1"], ["a0", "a1"], ["o0", "o1"], 1)
    assert rows(top, STORE, "o0", "o1") == [("a", 0.0, 0.0), ("b", 7.0, 0.0), ("c", 0.0, 0.0)]
    half = forecast.gate(df, ["c0", "c1"], ["a0", "a1"], ["o0", "o1"], 0.4)
    assert rows(half, STORE, "o0", "o1") == [("a", 0.0, 0.0), ("b", 7.0, 0.0), ("c", 0.0, 1.0)]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 2.0, 4.0, 4.0), (10.0, 5.0, 1.0, 2.0), (3.0, 3.0, 8.0, 2.0)], "y0 double, p0 double, y1 double, p1 double")
    errors = metrics.long_errors(df, ["y0", "y1"], ["p0", "p1"])
    assert rows(metrics.mae(errors), "horizon", "mae") == [("1", pytest.approx(7 / 3)), ("2", pytest.approx(7 / 3)), ("mean", pytest.approx(7 / 3))]
    assert dict(rows(metrics.mape1(errors), "horizon", "mape1"))["1"] == pytest.approx((2 + 0.5 + 0) / 3)
    assert rows(metrics.median_absolute_error(errors), "horizon", "medae") == [("1", 2.0), ("2", 1.0), ("mean", 1.5)]
    assert metrics.all_zero(errors).first()[0] is False
    even = metrics.long_errors(df.limit(2), ["y0"], ["p0"])
    assert dict(rows(metrics.median_absolute_error(even), "horizon", "medae"))["1"] == 3.5


@pytest.fixture(scope="module")
def frame(spark, folder):
    from demandloom.session import cut

    return cut(Retail(spark, folder).windows(("quantity", "net_value"), last_weeks=[42, 47, 52]))


def test_forecast(frame):
    out = forecast.forecast_next_weeks(frame, [52], features=NAMES, settings=QUICK)
    assert out.columns == [STORE, *[f"column_{h}" for h in range(5)]]
    assert out.count() == 150 and out.select(STORE).distinct().count() == 150
    with pytest.raises(ValueError):
        forecast.forecast_next_weeks(frame, [51, 52], features=NAMES, settings=QUICK)


def test_forecast_by_category(spark, folder):
    from demandloom.operators import weekly
    from demandloom.schema import CATEGORY
    from demandloom.session import cut

    r = Retail(spark, folder)
    facts = weekly.weekly_facts(r.positive, r.stores, CATEGORY)
    arrays = weekly.weekly_arrays(facts, CATEGORY, ("quantity", "net_value"))
    by_category = cut(windows.window_features(
        arrays, CATEGORY, measures=("quantity", "net_value"), last_weeks=[52], attributes_at_start=True
    ))
    out = forecast.forecast_next_weeks(by_category, [52], CATEGORY, NAMES, QUICK)
    assert out.columns[0] == CATEGORY and out.count() == 5
    assert out.where("column_0 > 0").count() > 0


def test_one_class_horizon_and_regressor_only(frame):
    names = windows.feature_columns(frame, NAMES)
    train = windows.training_frame(frame, 52, features=NAMES).withColumn("quantity09", F.lit(4.0))
    model = forecast.fit_hurdle(train, names, ["quantity09"], QUICK)
    assert model.constant == {0: 1.0}
    assert {round(r["column_0"], 6) for r in model.predict(train).collect()} == {4.0}
    alone = forecast.HurdleSettings(regressor=QUICK.regressor, classifier=None)
    assert forecast.fit_hurdle(train, names, ["quantity09"], alone).predict(train).count() == 150


def test_backtest(frame):
    table = forecast.backtest(frame, [47, 52], features=NAMES, settings=QUICK)
    assert table.count() == 2 * 2 * 4 * 6
    assert table.where("mae < 0 OR mae IS NULL").count() == 0
    with pytest.raises(ValueError):
        forecast.backtest(frame, [17], features=NAMES, settings=QUICK)


def test_search_is_reproducible(frame):
    names = windows.feature_columns(frame, NAMES)
    train = windows.training_frame(frame, 52, features=NAMES)
    targets = windows.target_columns()[:2]
    space = {"trees": tuning.Range(1, 3, whole=True), "rate": tuning.Range(0.1, 1.0, log=True), "depth": tuning.Range(2, 3, whole=True),
             "features": tuning.Range(0.4, 1.0)}
    once = tuning.tune_regressor(train, names, targets, space, trials=2, folds=2)
    again = tuning.tune_regressor(train.repartition(5), names, targets, space, trials=2, folds=2)
    pick = ("trial", "best", "parameter", "value")
    assert rows(once, *pick) == rows(again, *pick)
    assert once.where("best").select("trial").distinct().count() == 1
    assert tuning.best_parameters(once).count() == len(fields(forecast.TreeSettings))
    other = tuning.tune_classifier(train, names, targets, space, trials=2, folds=2)
    assert other.where("loss < 0 OR loss > 1").count() == 0


def test_draws_stay_in_their_ranges():
    for settings in tuning.candidates(tuning.REGRESSOR_SPACE, 50, 1):
        assert 20 <= settings.trees <= 400 and 2 <= settings.depth <= 6 and 1e-4 <= settings.rate <= 1


def test_complete_run(spark, folder, tmp_path):
    from demandloom import schema
    from demandloom.sources import tables

    r = Retail(spark, folder)
    tables.write_parquet(r.brand_sales.select(*schema.TRANSACTIONS.fieldNames()), str(tmp_path / "t"))
    tables.write_parquet(r.stores, str(tmp_path / "s"))
    settings = weekly_plan.PlanSettings(min_cluster_size=5, hurdle=QUICK)
    weekly_plan.run(spark, str(tmp_path / "t"), str(tmp_path / "s"), str(tmp_path / "out"), settings)
    plan = tables.read_plan_csv(spark, str(tmp_path / "out"))
    assert plan.count() > 0 and plan.where("quantidade <= 0").count() == 0
    assert {r[0] for r in plan.select("semana").distinct().collect()} <= {"1", "2", "3", "4", "5"}


def test_clusters_are_categories_however_many(frame):
    for k in (10, 60):
        grouped = frame.withColumn("cluster", F.pmod(F.xxhash64(STORE), F.lit(k)).cast("int"))
        names = (*NAMES, "cluster")
        train = windows.training_frame(grouped, 52, features=names)
        settings = forecast.HurdleSettings(
            regressor=QUICK.regressor, classifier=forecast.TreeSettings(2, 2, 0.1, 1.0, bins=16, held_out=0.2), threshold=0.5)
        model = forecast.fit_hurdle(train, windows.feature_columns(grouped, names), ["quantity09"], settings)
        assert len(model.inputs.encoder.categories["cluster"]) == train.select("cluster").distinct().count()
        assert model.chances.categories and not model.amounts.categories
        assert model.predict(train).count() == 150


def test_null_zips_and_measures_reach_the_plan(spark, folder):
    r = Retail(spark, folder)
    stores = r.stores.withColumn("zipcode", F.when(F.col("pdv").cast("int") % 10 > 0, F.col("zipcode")))
    odd = F.col(STORE).cast("int") % 2 == 1
    sales = r.brand_sales.withColumn("net_value", F.when(~odd, F.col("net_value")))
    settings = weekly_plan.PlanSettings(min_cluster_size=5, hurdle=QUICK)
    clustered = weekly_plan.cluster_stores(sales, stores, settings)
    # without a zip, or without any net value, a store has no place among the others
    assert clustered.where("cluster IS NULL").count() == 0
    assert clustered.where("zipcode IS NULL AND cluster = -2").count() == clustered.where("zipcode IS NULL").count() > 0
    forecasts = weekly_plan.forecast_stores(sales, clustered, settings)
    assert forecasts.count() == 150
    assert weekly_plan.plan(sales, stores, settings).count() > 0


def test_plan_reads_transactions_once(spark, folder, tmp_path, monkeypatch):
    from demandloom import schema
    from demandloom.sources import tables

    r = Retail(spark, folder)
    tables.write_parquet(r.brand_sales.select(*schema.TRANSACTIONS.fieldNames()), str(tmp_path / "t"))
    transactions = tables.read_transactions(spark, str(tmp_path / "t"))
    scans = []
    original = weekly_plan.cut

    def reads(df):
        return any("/t/part" in f for f in df.inputFiles())

    def counted(df):
        scans.append(reads(df))
        return original(df)

    monkeypatch.setattr(weekly_plan, "cut", counted)
    out = weekly_plan.plan(transactions, r.stores, weekly_plan.PlanSettings(min_cluster_size=5, hurdle=QUICK))
    assert scans[0] and not any(scans[1:]) and not reads(out)
