"""Table contracts and the calendar constants shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

STORE = "internal_store_id"
PRODUCT = "internal_product_id"
CATEGORY = "categoria_pdv"

# The yearly calendar, lag count, horizon and measures of the forecast.
WEEKS = 52
LAGS = 8
HORIZON = 5
MEASURES = ("quantity", "gross_value", "net_value", "gross_profit", "discount", "taxes")
WINDOWED = MEASURES + ("product_diversity",)

TRANSACTIONS = T.StructType([
    T.StructField(STORE, T.StringType()),
    T.StructField(PRODUCT, T.StringType()),
    T.StructField("distributor_id", T.LongType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("reference_date", T.DateType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("gross_value", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("taxes", T.DoubleType()),
    T.StructField("net_value", T.DoubleType()),
    T.StructField("gross_profit", T.DoubleType()),
])

STORES = T.StructType([
    T.StructField("pdv", T.StringType()),
    T.StructField("premise", T.StringType()),
    T.StructField(CATEGORY, T.StringType()),
    T.StructField("zipcode", T.IntegerType()),
])

SKU = T.StructType([
    T.StructField("produto", T.StringType()),
    T.StructField("descricao", T.StringType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("subcategoria", T.StringType()),
])

FORECAST_PLAN = T.StructType([
    T.StructField("semana", T.StringType()),
    T.StructField("pdv", T.StringType()),
    T.StructField("produto", T.StringType()),
    T.StructField("quantidade", T.IntegerType()),
])


def numbered(measure: str, k: int) -> str:
    """Name of the k-th week of a measure inside a window, e.g. ``quantity03``."""
    return f"{measure}{k:02d}"

# Store attributes that weekly facts carry along.
WEEKED_STATICS = ("cluster", "premise")
