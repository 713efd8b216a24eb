"""Cleaning: positive sales, stores that sell, sales of known stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import is_on_premise, premise_contains_on, repair_zip, week_of
from demandloom.schema import STORE


def positive_sales(transactions: DataFrame) -> DataFrame:
    """Drop returns and empty lines; the predicate reaches the Parquet scan."""
    return transactions.where(F.col("quantity") > 0)


def active_stores(stores: DataFrame, sales: DataFrame) -> DataFrame:
    """Stores with at least one sale.

    The sales side is reduced to its distinct stores before the shuffle, so a store that
    owns a third of all rows costs one row per map task.
    """
    selling = sales.select(F.col(STORE).alias("pdv")).distinct()
    return stores.join(selling, "pdv", "left_semi")


def known_transactions(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales of stores in the store table.

    No hint: Spark broadcasts the store keys while they are under its size limit, and
    otherwise splits hot stores in the adaptive sort-merge join.
    """
    return sales.join(stores.select(F.col("pdv").alias(STORE)), STORE, "left_semi")


def clean_tables(transactions: DataFrame, stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positive sales of known stores, and the stores that have any."""
    sales = positive_sales(transactions)
    return known_transactions(sales, stores), active_stores(stores, sales)


def enrich(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales with their store's attributes and the ISO week; unknown stores drop out."""
    return (
        sales.join(stores.withColumnRenamed("pdv", STORE), STORE, "inner")
        .withColumn("week", week_of(F.col("transaction_date")))
    )


def with_premise_flags(stores: DataFrame) -> DataFrame:
    """Both readings of the premise text as separate 0/1 columns."""
    return stores.select(
        "*",
        is_on_premise(F.col("premise")).alias("is_on_premise"),
        premise_contains_on(F.col("premise")).alias("premise_contains_on"),
    )


def with_clean_zip(stores: DataFrame, **rules) -> DataFrame:
    return stores.withColumn("zipcode", repair_zip(F.col("zipcode"), **rules))


def clean_sku(sku: DataFrame) -> DataFrame:
    return sku.drop("subcategoria")
