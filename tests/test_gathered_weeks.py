"""Product rows go to their store at once: what follows by store moves no rows."""

from pyspark.sql import functions as F

from demandloom.catalog.views import Retail
from demandloom.operators import weekly
from demandloom.schema import PRODUCT, STORE


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_weekly_facts_shuffle_sales_twice(spark, folder):
    r = Retail(spark, folder)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        raw = r.positive.select(STORE, PRODUCT, "transaction_date", *weekly.MEASURES)
        before = exchanges(raw)
        arrays = weekly.weekly_arrays(weekly.weekly_facts(r.positive, r.stores.hint("broadcast")))
        assert exchanges(arrays) - before == 2  # by (store, week, product), and by store
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_gathered_weeks_are_the_same(spark):
    sales = spark.range(400).select(
        F.when(F.col("id") % 11 > 0, (F.col("id") % 5).cast("string")).alias(STORE), (F.col("id") % 7).cast("string").alias(PRODUCT),
        F.date_add(F.lit("2000-01-03").cast("date"), (F.col("id") % 40).cast("int")).alias("transaction_date"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("quantity"))
    found = [weekly.store_weeks(sales, ["quantity"], gathered=g) for g in (False, True)]
    assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect()))
    assert found[1].where(f"{STORE} IS NULL").count() > 0 and found[1].count() > 20
