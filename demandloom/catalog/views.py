"""The sample order tables read as retail tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators import bandit, density, forecast, prepare, profile, weekly, windows
from demandloom.schema import CATEGORY, PRODUCT, STORE
from demandloom.session import cut

# The product of allocation queries is the brand: with thousands of products per category
# every share of a store's weekly volume floors to zero.
SEED = 42


# Materialised steps that several queries of one session start from.
_STEPS: dict[tuple, object] = {}


@dataclass
class Retail:
    """Lazy frames that most queries start from."""

    spark: SparkSession
    folder: str

    def once(self, name: str, build: Callable):
        """A materialised step, built once per session and folder."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STEPS:
            _STEPS[key] = build()
        return _STEPS[key]

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def transactions(self) -> DataFrame:
        price, off, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
        lines = self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.select(
            F.col("o_custkey").cast("string").alias(STORE),
            F.col("l_partkey").cast("string").alias(PRODUCT),
            F.col("l_suppkey").alias("distributor_id"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            F.date_trunc("month", "l_shipdate").cast("date").alias("reference_date"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity"),
            price.alias("gross_value"),
            (price * off).alias("discount"),
            (price * (1 - off) * tax).alias("taxes"),
            (price * (1 - off)).alias("net_value"),
            (price * (1 - off) * (1 - tax)).alias("gross_profit"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").cast("string").alias("pdv"),
            F.when(F.col("c_custkey") % 3 == 0, "On Premise").otherwise("Off Premise").alias("premise"),
            F.col("c_mktsegment").alias(CATEGORY),
            (F.lit(8100) + F.col("c_nationkey")).alias("zipcode"),
        )

    @cached_property
    def sku(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("produto"), F.col("p_name").alias("descricao"),
            F.col("p_type").alias("categoria"), F.col("p_brand").alias("subcategoria"),
        )

    @cached_property
    def positive(self) -> DataFrame:
        return prepare.positive_sales(self.transactions)

    @cached_property
    def clean(self) -> tuple[DataFrame, DataFrame]:
        return prepare.clean_tables(self.transactions, self.stores)

    @property
    def sales(self) -> DataFrame:
        return self.clean[0]

    @property
    def active(self) -> DataFrame:
        return self.clean[1]

    @cached_property
    def brand_sales(self) -> DataFrame:
        brands = self.sku.select(F.col("produto").alias(PRODUCT), F.col("subcategoria").alias("brand"))
        return self.positive.join(brands, PRODUCT).withColumn(PRODUCT, F.col("brand")).drop("brand")

    # Facts, windows and profiles are joined with the stores after aggregation; that inner
    # join keeps known stores only, so raw sales need no semi join before it.

    @cached_property
    def facts(self) -> DataFrame:
        return weekly.weekly_facts(self.positive, self.stores)

    @cached_property
    def attributes(self) -> DataFrame:
        return weekly.store_attributes(self.stores)

    def windows(self, measures: Sequence[str], **options) -> DataFrame:
        return windows.store_windows(self.positive, self.attributes, measures, **options)

    def grouped_windows(self, last_weeks: Sequence[int]) -> DataFrame:
        """Windows of all default features, with groups of zip codes as clusters."""
        grouped = self.stores.withColumn("cluster", ((F.col("zipcode") - 8100) / 5).cast("int"))
        return windows.store_windows(
            self.positive, weekly.store_attributes(grouped), windows.windowed_measures(), last_weeks=last_weeks)

    @cached_property
    def arms(self) -> DataFrame:
        return bandit.arm_weeks(self.positive, self.stores)

    @cached_property
    def brand_shares(self) -> DataFrame:
        return bandit.category_shares(bandit.draw(bandit.arm_weeks(self.brand_sales, self.stores), SEED))

    @cached_property
    def profile(self) -> DataFrame:
        return profile.store_profile(self.positive, self.stores)

    @property
    def scaled(self) -> DataFrame:
        return self.once("scaled", lambda: cut(profile.scaled_store_features(self.profile)))

    @property
    def space(self) -> density.Space:
        return self.once("space", lambda: density.index_points(self.scaled))

    def hierarchy(self, size: int) -> density.Hierarchy:
        return self.once(f"hierarchy{size}", lambda: density.build_hierarchy(self.space, size, size))

    def clustered(self, size: int, epsilon: float) -> DataFrame:
        def build():
            labels = density.leaf_clusters(self.hierarchy(size), size, epsilon)
            return cut(density.with_clusters(self.stores, labels))
        return self.once(f"clusters{size}:{epsilon}", build)

    def naive(self, **options) -> DataFrame:
        return forecast.naive_forecast(self.windows(("quantity",), last_weeks=[52]), **options)
