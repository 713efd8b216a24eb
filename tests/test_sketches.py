"""Sketches against exact ranks and counts, and contracts checked by the pass that writes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import quality, sketches
from test_weekly import rows


def test_quantiles_of_merged_slices(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=4000), np.full(3000, 2.0), rng.exponential(size=3000) * 100])
    data = [(int(i % 9), float(v), None if i % 3 else float(i), None) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "slice int, a double, b double, c double").repartition(6)
    found = sketches.merged_quantiles(sketches.quantile_sketches(df, ["slice"], ["a", "b", "c"]), [], ["a", "b", "c"], (0.1, 0.5, 0.9))
    assert sorted({(r.column_name, r.share) for r in found.collect()}) == [(c, s) for c in "ab" for s in (0.1, 0.5, 0.9)]
    bounds = sketches.rank_bounds(df, found)
    assert bounds.select(F.bool_and(sketches.within_rank_error(bounds))).first()[0]
    assert {r.n for r in bounds.collect()} == {10000, 3334}
    empty = df.limit(0)
    assert sketches.merged_quantiles(sketches.quantile_sketches(empty, ["slice"], ["a"]), ["slice"], ["a"]).count() == 0


def test_distinct_counts_roll_up(spark):
    df = spark.range(60000).select((F.col("id") % 50).alias("store"), (F.col("id") % 7).alias("week"), (F.col("id") % 9973).alias("product"),
                                   F.lit(None).cast("string").alias("nothing"))
    by_week = sketches.distinct_sketches(df, ["store", "week"], ["product", "nothing"])
    assert by_week.count() == 350
    total = sketches.merged_distinct(by_week, [], ["product", "nothing"]).first()
    assert total["nothing"] == 0 and abs(total["product"] - 9973) <= sketches.DISTINCT_ERROR * 9973
    stores = {r.store: r.product for r in sketches.merged_distinct(by_week, ["store"], ["product"]).collect()}
    exact = {r.store: r.n for r in df.groupBy("store").agg(F.count_distinct("product").alias("n")).collect()}
    assert all(abs(stores[s] - n) <= sketches.DISTINCT_ERROR * n for s, n in exact.items())


def test_unique_rows_checks_while_writing(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), (None, 3, "y")], "pdv string, n int, row string")
    writes = []
    original = quality.cut
    monkeypatch.setattr(quality, "cut", lambda d: writes.append(1) or original(d))
    monkeypatch.setattr(quality, "key_violations", None)  # no job of its own
    filled = {"pdv": "-", "row": "-"}
    assert rows(quality.unique_rows(df, ["pdv"]).na.fill(filled), *df.columns) == rows(df.na.fill(filled), *df.columns)
    assert len(writes) == 1
    with pytest.raises(ValueError, match="not unique"):
        quality.unique_rows(df.unionByName(df.limit(1)), ["pdv"])
    assert quality.unique_rows(df.limit(0), ["pdv"]).count() == 0
    assert quality.unique_rows(df.select("pdv"), ["pdv"]).columns == ["pdv"]
