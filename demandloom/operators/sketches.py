"""Quantiles and distinct counts from mergeable sketches, one per slice of time, that roll up to any period or group.

A slice is read once; its sketches are a few KB, whatever its rows, and merge without the rows. Quantiles come from KLL sketches,
whose error is in ranks: the share of values up to a returned quantile is within ``RANK_ERROR`` of the one asked for. Distinct
counts come from HyperLogLog sketches, whose error is relative: within ``DISTINCT_ERROR`` of the exact count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 400
RANK_ERROR = 0.02       # over twice the 99 % bound at this size
HLL_BITS = 12
DISTINCT_ERROR = 0.08   # five standard errors at this size
QUARTILES = (0.25, 0.5, 0.75)


def quantile_sketches(rows: DataFrame, by: Sequence[str | Column], measures: Sequence[str], size: int = KLL_SIZE) -> DataFrame:
    """One sketch per measure (``kll_<measure>``) and slice; nulls are not counted."""
    return rows.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(m).cast("double"), size).alias(f"kll_{m}") for m in measures])


def merged_quantiles(sketches: DataFrame, by: Sequence[str], measures: Sequence[str], shares: Sequence[float] = QUARTILES) -> DataFrame:
    """(by, column_name, share, value) of the merged sketches. A measure without values has no rows."""
    merged = sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(f"kll_{m}").alias(f"kll_{m}") for m in measures])
    asked = F.array(*[F.lit(float(s)) for s in shares])
    cells = [
        F.struct(F.lit(m).alias("column_name"), F.when(F.kll_sketch_get_n_double(f"kll_{m}") > 0, F.arrays_zip(
            asked.alias("share"), F.kll_sketch_get_quantile_double(f"kll_{m}", asked).alias("value"))).alias("cells"))
        for m in measures
    ]
    rows = merged.select(*by, F.inline(F.array(*cells)))
    return rows.select(*by, "column_name", F.inline("cells")).toDF(*by, "column_name", "share", "value")


def rank_bounds(rows: DataFrame, quantiles: DataFrame) -> DataFrame:
    """(column_name, share, n, below, upto): exact shares of the values below and up to each quantile, in one pass over the rows."""
    asked = [(r["column_name"], r["share"], r["value"]) for r in quantiles.collect()]  # a row per column and share
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("share"), F.count(c).alias("n"),
                 F.count_if(F.col(c) < v).alias("less"), F.count_if(F.col(c) <= v).alias("most"))
        for c, s, v in asked
    ]
    if not cells:
        return quantiles.select("column_name", "share", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("below"), F.lit(0.0).alias("upto")).limit(0)
    return rows.agg(F.array(*cells).alias("cells")).select(F.inline("cells")).select(
        "column_name", "share", "n", (F.col("less") / F.col("n")).alias("below"), (F.col("most") / F.col("n")).alias("upto"))


def within_rank_error(bounds: DataFrame, error: float = RANK_ERROR) -> Column:
    """Whether the share asked for lies within ``error`` of the exact ranks of its quantile."""
    return (bounds["below"] - error <= bounds["share"]) & (bounds["share"] <= bounds["upto"] + error)


def distinct_sketches(rows: DataFrame, by: Sequence[str | Column], columns: Sequence[str], bits: int = HLL_BITS) -> DataFrame:
    """One sketch per column (``hll_<column>``) and slice; nulls are not counted."""
    return rows.groupBy(*by).agg(*[F.hll_sketch_agg(c, bits).alias(f"hll_{c}") for c in columns])


def merged_distinct(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Estimated distinct values per group, under the columns' names."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"hll_{c}")).alias(c) for c in columns])
