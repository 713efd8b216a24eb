"""Store profiles and the scaled features that clustering works on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.columns import premise_contains_on, repair_zip
from demandloom.schema import CATEGORY, MEASURES, PRODUCT, STORE
from demandloom.session import cut

# "transaction_rows" and "transaction_count" are the same number on purpose: the row count
# enters the distance twice. Pass a shorter list to weigh it once.
CLUSTER_FEATURES = (
    "zipcode", "transaction_rows", "quantity", "net_value", "distributor_count", "transaction_count",
)


def store_profile(sales: DataFrame, stores: DataFrame, with_premise: bool = False) -> DataFrame:
    """Per selling store: rows, mean quantity and net value, zip, distinct distributors. Takes sales or ``sale_lines``."""
    if "transaction_date" in sales.columns:
        rows, means = F.count("*"), [F.avg(m).alias(m) for m in ("quantity", "net_value")]
    else:
        rows, means = F.sum("rows"), [F.try_divide(F.sum(m), F.sum(f"n_{m}")).alias(m) for m in ("quantity", "net_value")]
    per_store = sales.groupBy(F.col(STORE).alias("pdv")).agg(
        rows.alias("transaction_rows"), *means, F.count_distinct("distributor_id").alias("distributor_count"),
    )
    extra = [premise_contains_on(F.col("premise")).alias("premise_dummy")] if with_premise else []
    attributes = stores.select("pdv", repair_zip(F.col("zipcode")).alias("zipcode"), *extra)
    return per_store.join(attributes, "pdv").withColumn("transaction_count", F.col("transaction_rows"))


def store_profile_full(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Per selling store: six means, zip, category, distributors, rows and products.

    ``transacted_products`` holds (product, rows) pairs in product order. That is the
    whole multiset of sold products, but as long as the assortment instead of the sales.
    """
    level = sales.groupBy(STORE, PRODUCT, "distributor_id").agg(
        F.count("*").alias("rows"),
        *[F.sum(m).alias(m) for m in MEASURES],
        *[F.count(m).alias(f"n_{m}") for m in MEASURES],
    )
    products = level.groupBy(STORE, PRODUCT).agg(
        F.sum("rows").alias("rows"),
        *[F.sum(m).alias(m) for m in MEASURES],
        *[F.sum(f"n_{m}").alias(f"n_{m}") for m in MEASURES],
    )
    distributors = level.groupBy(STORE).agg(F.count_distinct("distributor_id").alias("distributor_count"))
    per_store = products.groupBy(STORE).agg(
        F.sum("rows").alias("transaction_count"),
        *[F.try_divide(F.sum(m), F.sum(f"n_{m}")).alias(m) for m in MEASURES],
        F.array_sort(F.collect_list(F.struct(F.col(PRODUCT).alias("product"), "rows"))).alias("transacted_products"),
    )
    attributes = stores.select(
        F.col("pdv").alias(STORE), repair_zip(F.col("zipcode")).alias("zipcode"), CATEGORY
    )
    return per_store.join(distributors, STORE).join(attributes, STORE).withColumnRenamed(STORE, "pdv")


def ordinal_codes(df: DataFrame, column: str, prefix: int = 3) -> DataFrame:
    """Position of every distinct value in sorted order, from 0.

    Values are ranked inside their first ``prefix`` characters; the ranks before each
    prefix are added. Sorting by prefix first does not change the order of strings.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn(
        "head", F.substring(column, 1, prefix)
    )
    heads = values.groupBy("head").agg(F.count("*").alias("size")).select(
        "head", (F.sum("size").over(Window.orderBy("head")) - F.col("size")).alias("before")
    )
    rank = F.row_number().over(Window.partitionBy("head").orderBy(column))
    return values.join(heads, "head").select(column, (F.col("before") + rank - 1).cast("int").alias("code"))


def with_zip_ordinal(profile: DataFrame) -> DataFrame:
    """Replace the zip text by its ordinal code; a store without zip stays, with a null code."""
    codes = ordinal_codes(profile, "zipcode")
    return profile.join(codes, "zipcode", "left").drop("zipcode").withColumnRenamed("code", "zipcode")


def scaler_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean and population deviation of every column; a constant scales by 1."""
    return df.agg(F.struct(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"std_{c}") for c in columns],
    ).alias("scaler"))


def apply_scaler(df: DataFrame, statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise with statistics that may come from another frame (fit, then score).

    The one-row statistics enter as one scalar subquery, so there is no join at all.
    """
    kept = df.columns
    fitted = df.withColumn("scaler", statistics.scalar())
    return fitted.withColumns({
        c: (F.col(c) - F.col(f"scaler.mean_{c}")) / F.col(f"scaler.std_{c}") for c in columns
    }).select(*kept)


def scaled_store_features(profile: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """Ordinal zip, then every feature standardised; the store id passes through.

    The profile (one row per store) is materialised first: codes and statistics read it
    again, and must not go back to the sales.
    """
    profile = cut(profile.select("pdv", *features))
    coded = with_zip_ordinal(profile) if "zipcode" in features else profile
    kept = coded.select("pdv", *[F.col(c).cast("double").alias(c) for c in features])
    return apply_scaler(kept, scaler_statistics(kept, features), features)
