"""Ordinal weeks and windows across years against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandloom.operators import timeline
from demandloom.schema import STORE


def test_ordinal_weeks_have_no_gaps(spark):
    days = [dt.date(1969, 12, 20) + dt.timedelta(n) for n in range(0, 20000, 1)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", timeline.week_ordinal(F.col("d")).alias("w")).orderBy("d").collect()
    for a, b in zip(got, got[1:]):
        assert b.w - a.w == (b.d.isoweekday() == 1)
    assert next(r.w for r in got if r.d == dt.date(1970, 1, 1)) == 0


@pytest.mark.parametrize("length", [1, 13, 52])
def test_windows_cross_blocks(spark, length):
    rng = random.Random(length)
    sold = {(s, w): float(rng.randint(1, 99)) for s in "abc" for w in rng.sample(range(1300, 1560), 90)}
    sold |= {("late", 1559): 5.0}
    facts = spark.createDataFrame([(s, w, q, None) for (s, w), q in sold.items()], f"{STORE} string, week long, quantity double, net_value double")
    first, last = min(w for _, w in sold), max(w for _, w in sold)
    got = {(r[STORE], r["week"]): [r[f"quantity{k:02d}"] for k in range(1, length + 1)] for r in timeline.long_windows(
        facts, ["quantity", "net_value"], length=length).collect()}
    want = {(s, end): [sold.get((s, end - length + k), 0.0) for k in range(1, length + 1)]
            for s in ("a", "b", "c", "late") for end in range(first + length - 1, last + 1)}
    assert got == want


def test_bounds_and_short_calendars(spark):
    facts = spark.createDataFrame([("a", 10, 1.0), ("a", 12, 2.0), ("b", 99, 9.0)], f"{STORE} string, week long, quantity double")
    inside = timeline.long_windows(facts, ["quantity"], length=2, first=10, last=12).orderBy(STORE, "week").collect()
    assert [tuple(r) for r in inside] == [("a", 11, 1.0, 0.0), ("a", 12, 0.0, 2.0), ("b", 11, 0.0, 0.0), ("b", 12, 0.0, 0.0)]
    assert timeline.long_windows(facts, ["quantity"], length=13, first=10, last=12).count() == 0
    assert timeline.long_windows(facts.limit(0), ["quantity"]).count() == 0
    with pytest.raises(ValueError):
        timeline.long_windows(facts, ["quantity"], length=53)
