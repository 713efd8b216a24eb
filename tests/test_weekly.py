import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom import schema
from demandloom.operators import prepare, profile, quality, weekly, windows
from demandloom.schema import CATEGORY, PRODUCT, STORE

MONDAY = dt.date(2021, 1, 4)  # first day of ISO week 1


def sale(store, product, week, quantity=1.0, distributor=1):
    day = MONDAY + dt.timedelta(weeks=week - 1)
    return (store, product, distributor, day, day, float(quantity), 10.0, 1.0, 1.0, 9.0, 8.0)


def sales_frame(spark, rows):
    return spark.createDataFrame([sale(*r) for r in rows], schema.TRANSACTIONS)


def stores_frame(spark, rows):
    return spark.createDataFrame(rows, schema.STORES)


STORES = [("a", "On Premise", "bar", 8107), ("b", "Off Premise", "shop", 1234), ("c", "On the go", "shop", 99)]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def small(spark):
    sales = sales_frame(spark, [("a", "x", 1, 2), ("a", "x", 1, 3), ("a", "y", 1, 1), ("a", "y", 3, 4), ("b", "x", 2, 5)])
    return sales, stores_frame(spark, STORES)


def test_sums_and_counts(small):
    facts = weekly.weekly_facts(*small)
    assert rows(facts, STORE, "week", "quantity", "product_rows", "product_diversity", "most_bought_product", "premise") == [
        ("a", 1, 6.0, 3, 2, "x", 1), ("a", 3, 4.0, 1, 1, "y", 1), ("b", 2, 5.0, 1, 1, "x", 0),
    ]


def test_calendar_is_dense(small):
    calendar = weekly.dense_calendar(weekly.store_weeks(small[0]))
    assert calendar.count() == 2 * 52
    assert rows(calendar.where("quantity > 0"), STORE, "week", "quantity") == [("a", 1, 6.0), ("a", 3, 4.0), ("b", 2, 5.0)]


def test_smallest_product_wins_ties(spark):
    sales = sales_frame(spark, [("a", "z", 5), ("a", "m", 5), ("a", "k", 5, 9), ("a", "z", 6), ("a", "m", 7)])
    facts = weekly.store_weeks(sales)
    assert rows(facts, "week", "most_bought_product") == [(5, "k"), (6, "z"), (7, "m")]
    assert rows(weekly.usual_product(facts), STORE, "most_bought_product") == [("a", "k")]


def test_category_facts(spark):
    stores = stores_frame(spark, STORES).withColumn("cluster", F.when(F.col("pdv") == "b", 7).otherwise(3))
    sales = sales_frame(spark, [("b", "x", 1, 4), ("c", "y", 1, 2), ("c", "y", 1, 3), ("gone", "x", 1, 100)])
    facts = weekly.weekly_facts(sales, stores, CATEGORY)
    assert rows(facts, CATEGORY, "week", "quantity", "product_rows", "product_diversity", "most_bought_product", "cluster",
                "premise") == [("shop", 1, 3.0, 3, 2, "y", 3, 0)]
    with pytest.raises(ValueError):
        weekly.weekly_facts(sales, stores, "zipcode")


def test_week_53_is_outside_but_keeps_the_store(spark):
    sales = spark.createDataFrame(
        [("a", "x", 1, dt.date(2020, 12, 31), dt.date(2020, 12, 31), 7.0, 1.0, 0.0, 0.0, 1.0, 1.0)], schema.TRANSACTIONS
    )
    facts = weekly.store_weeks(sales)
    assert rows(facts, "week") == [(53,)]
    assert weekly.dense_calendar(facts).agg(F.count("*"), F.sum("quantity")).first() == (52, 0.0)


def test_cleaning(spark):
    sales = sales_frame(spark, [("a", "x", 1, 2), ("a", "x", 1, -2), ("b", "x", 1, 0), ("unknown", "x", 1, 1)])
    kept, active = prepare.clean_tables(sales, stores_frame(spark, STORES))
    assert rows(kept, STORE, "quantity") == [("a", 2.0)]
    assert rows(active, "pdv") == [("a",)]


def test_premise_and_zip_rules(spark):
    stores = stores_frame(spark, STORES)
    assert rows(prepare.with_premise_flags(stores), "pdv", "is_on_premise", "premise_contains_on") == [
        ("a", 1, 1), ("b", 0, 0), ("c", 0, 1)]
    assert rows(prepare.with_clean_zip(stores), "zipcode") == [("08107",), ("1234",), ("99",)]
    assert rows(prepare.with_clean_zip(stores, width=5), "zipcode") == [("00099",), ("01234",), ("08107",)]


def test_key_checks(spark):
    stores = stores_frame(spark, STORES + [STORES[0]])
    assert rows(quality.key_violations(stores, ["pdv"]), "pdv", "rows") == [("a", 2)]
    with pytest.raises(ValueError):
        quality.require_unique(stores, ["pdv"])
    with pytest.raises(ValueError):
        quality.require_columns(stores, ["pdv", "nothing"])


def test_profiles(small):
    per_store = profile.store_profile(*small, with_premise=True)
    assert rows(per_store, "pdv", "transaction_rows", "quantity", "zipcode", "distributor_count", "premise_dummy") == [
        ("a", 4, 2.5, "08107", 1, 1), ("b", 1, 5.0, "1234", 1, 0)]
    full = profile.store_profile_full(*small)
    assert [(p["product"], p["rows"]) for p in full.where("pdv = 'a'").first()["transacted_products"]] == [("x", 2), ("y", 2)]


def test_ordinals_follow_text_order(spark):
    zips = ["9", "08107", "0810", "10", "100", "99", "081", "1"]
    codes = profile.ordinal_codes(spark.createDataFrame([(z,) for z in zips + zips], "zipcode string"), "zipcode")
    assert [z for z, _ in sorted(((r["zipcode"], r["code"]) for r in codes.collect()), key=lambda t: t[1])] == sorted(zips)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([("a", 5.0, 1.0), ("b", 5.0, 3.0)], "pdv string, flat double, wide double")
    scaled = profile.apply_scaler(df, profile.scaler_statistics(df, ["flat", "wide"]), ["flat", "wide"])
    assert rows(scaled, "pdv", "flat", "wide") == [("a", 0.0, -1.0), ("b", 0.0, 1.0)]


@pytest.fixture(scope="module")
def ramp(spark):
    """One store that sells w units in week w."""
    sales = sales_frame(spark, [("a", "x", w, w) for w in range(1, 53)])
    stores = stores_frame(spark, STORES).withColumn("cluster", F.lit(4))
    return sales, stores


def test_forty_windows(ramp):
    frame = windows.store_windows(ramp[0], weekly.store_attributes(ramp[1]))
    assert frame.count() == 40
    last = frame.where("week = 52").first()
    assert [last[f"quantity{k:02d}"] for k in range(1, 14)] == [float(w) for w in range(40, 53)]
    assert (last["cluster"], last["premise"]) == (4, 1)


def test_scoring_lags(ramp):
    frame = windows.store_windows(ramp[0], weekly.store_attributes(ramp[1]), last_weeks=[52])
    lags = lambda mode: [int(windows.scoring_frame(frame, mode=mode).first()[f"quantity{k:02d}"]) for k in range(1, 9)]
    assert lags("contiguous") == [45, 46, 47, 48, 49, 50, 51, 52]
    assert lags("compat") == [45, 46, 47, 48, 49, 45, 46, 47]
    with pytest.raises(ValueError):
        windows.scoring_frame(frame, mode="other")


def test_feature_rules(ramp):
    frame = windows.store_windows(ramp[0], weekly.store_attributes(ramp[1]), last_weeks=[52])
    assert len(windows.feature_columns(frame)) == 26
    with pytest.raises(ValueError):
        windows.feature_columns(frame, ("net_value",))
    with pytest.raises(ValueError):
        windows.feature_columns(frame, ("quantity", "different_products"))
    with pytest.raises(ValueError):
        windows.window_features(weekly.weekly_arrays(weekly.store_weeks(ramp[0])), last_weeks=[12])


def test_attributes_at_window_start(spark):
    sales = sales_frame(spark, [("a", "x", 1), ("a", "x", 14)])
    stores = stores_frame(spark, STORES).withColumn("cluster", F.lit(4))
    arrays = weekly.weekly_arrays(weekly.weekly_facts(sales, stores))
    frame = windows.window_features(arrays, attributes_at_start=True, last_weeks=[13, 14, 26])
    assert rows(frame, "week", "cluster", "premise") == [(13, 4.0, 1.0), (14, 0.0, 0.0), (26, 4.0, 1.0)]


def test_sold_week_plans_do_not_use_python_or_products(ramp):
    frame = windows.store_windows(ramp[0], weekly.store_attributes(ramp[1]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoop", "Window"):
        assert bad not in plan


def test_column_rules(spark):
    from demandloom.functions import columns as cols

    df = spark.createDataFrame([("a", 1.0, None, 3.0)], "k string, column_0 double, column_1 double, other_1 double")
    assert cols.columns_with_suffix(df, "_1") == ["column_1", "other_1"]
    assert cols.columns_with_suffix(df, "_1", outside_prefix="column") == ["other_1"]
    assert df.select(cols.horizontal_sum([F.col("column_0"), F.col("column_1")])).first()[0] == 1.0
    zero = spark.createDataFrame([([0.0, 0.0],), ([1.0, 3.0],)], "p array<double>")
    assert [r[0] for r in zero.select(cols.normalise_array(F.col("p"))).collect()] == [[None, None], [0.25, 0.75]]


def test_sources(spark, tmp_path, small):
    from demandloom.sources import tables

    tables.write_parquet(small[0], str(tmp_path / "t"))
    tables.write_parquet(small[1], str(tmp_path / "s"))
    spark.createDataFrame([("x", "d", "c", "s")], schema.SKU).write.parquet(str(tmp_path / "k"))
    sku, sales, stores = tables.scan_tables(spark, str(tmp_path / "k"), str(tmp_path / "t"), str(tmp_path / "s"))
    assert (sku.count(), sales.count(), stores.count()) == (1, 5, 2)
    assert prepare.clean_sku(sku).columns == ["produto", "descricao", "categoria"]
    plan = spark.createDataFrame([("1", "a", "x", 3)], schema.FORECAST_PLAN)
    tables.write_plan(plan, str(tmp_path / "p"), single_file=True)
    text = next((tmp_path / "p").glob("part-*.csv")).read_text()
    assert text == "semana;pdv;produto;quantidade\n1;a;x;3\n"
    assert tables.read_plan_csv(spark, str(tmp_path / "p")).collect() == plan.collect()


def test_date_bounds_prune_folders(spark, folder, tmp_path):
    from datetime import date

    from demandloom.catalog.views import Retail
    from demandloom.sources import tables

    transactions = Retail(spark, folder).transactions
    tables.write_transactions(transactions, str(tmp_path / "t"))
    first, last = date(1997, 3, 10), date(1997, 5, 2)
    some = tables.read_transactions(spark, str(tmp_path / "t"), first, last)
    assert some.count() == transactions.where(F.col("transaction_date").between(first, last)).count() > 0
    assert "PartitionFilters: [isnotnull(reference_date" in some._jdf.queryExecution().executedPlan().toString()
    assert len(some.inputFiles()) >= 1 and some.columns[:3] == transactions.columns[:3]


def test_scratch_scope_removes_its_tables(spark):
    import os

    from demandloom.session import cut, scratch_scope

    with scratch_scope(spark):
        made = cut(spark.range(3))
        path = made.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
