"""Parquet scans with a declared schema, and the Parquet and CSV sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import schema
from demandloom.operators.prepare import clean_tables
from demandloom.operators.quality import require_columns


def read_table(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Lazy scan; the declared schema saves the footer read and fixes the types."""
    return spark.read.schema(columns).parquet(path)


def read_sku(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schema.SKU)


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schema.STORES)


def read_transactions(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Transactions, on request of the days first..last only.

    The bounds also go to the month of sale, so that a table written by month (``write_transactions``) is pruned to whole
    folders and any other by Parquet statistics.
    """
    rows = read_table(spark, path, schema.TRANSACTIONS)
    if first is not None:
        rows = rows.where((F.col("transaction_date") >= F.lit(first)) & (F.col("reference_date") >= F.lit(first.replace(day=1))))
    if last is not None:
        rows = rows.where((F.col("transaction_date") <= F.lit(last)) & (F.col("reference_date") <= F.lit(last.replace(day=1))))
    return rows


def write_transactions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Transactions in one folder per month of sale."""
    write_parquet(df.select(*schema.TRANSACTIONS.fieldNames()), path, mode, "reference_date")


def scan_tables(spark: SparkSession, sku: str, transactions: str, stores: str):
    """The three inputs, with sales and stores restricted to each other."""
    sales, active = clean_tables(read_transactions(spark, transactions), read_stores(spark, stores))
    return read_sku(spark, sku), sales, active


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: str | None = None) -> None:
    """Parquet sink, lz4. ``partition_by`` lets later scans prune whole folders."""
    writer = df.write.mode(mode).option("compression", "lz4_raw")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    """CSV sink with ``;`` and a header: a folder of parts, or one part on request."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("sep", ";").option("header", True).csv(path)


def read_plan_csv(spark: SparkSession, path: str) -> DataFrame:
    """A written forecast plan."""
    return spark.read.schema(schema.FORECAST_PLAN).option("sep", ";").option("header", True).csv(path)


def write_plan(plan: DataFrame, path: str, **options) -> None:
    """Check the output columns, then write the plan."""
    require_columns(plan, schema.FORECAST_PLAN.fieldNames())
    write_csv(plan.select(*schema.FORECAST_PLAN.fieldNames()), path, **options)
