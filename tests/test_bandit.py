import math

import numpy as np
import pytest
from brute import week_loop
from pyspark.sql import functions as F

from demandloom.functions.random import keyed_beta
from demandloom.operators import allocate as alloc
from demandloom.operators import bandit
from demandloom.schema import CATEGORY, PRODUCT, STORE
from test_weekly import STORES, rows, sales_frame, stores_frame


def arms_frame(spark, sold):
    data = [("k", arm, sum(1 << w for w in weeks if w <= 52)) for arm, weeks in sold.items()]
    return spark.createDataFrame(data, f"{CATEGORY} string, {PRODUCT} string, mask long")


@pytest.fixture(scope="module")
def sold():
    rng = np.random.default_rng(7)
    out = {"never": set(), "first": {1}, "always": set(range(1, 53)), "late": {53}}
    out |= {f"r{i}": set(rng.choice(np.arange(1, 54), size=rng.integers(1, 40), replace=False).tolist()) for i in range(30)}
    return out


def test_closed_form_equals_week_loop(spark, sold):
    arms = arms_frame(spark, sold)
    expected = week_loop({a: {w for w in ws if w <= 52} for a, ws in sold.items()})
    final = {r[PRODUCT]: (r["alpha"], r["beta"]) for r in bandit.posterior(arms).collect()}
    assert final == {a: e[:2] for a, e in expected.items()}
    drawn = {r[PRODUCT]: (r["alpha"], r["beta"]) for r in bandit.last_draw_parameters(arms).collect()}
    assert drawn == {a: e[2] or (None, None) for a, e in expected.items()}
    assert (final["never"], final["first"], final["always"], final["late"]) == ((1, 53), (2, 52), (53, 1), (1, 53))
    assert (drawn["first"], drawn["always"]) == ((2, 1), (53, 1))


def test_trajectory_ends_at_posterior(spark, sold):
    arms = arms_frame(spark, sold)
    steps = bandit.trajectory(arms)
    assert steps.count() == 52 * len(sold)
    assert steps.where("alpha + beta != week + 2").count() == 0
    assert rows(steps.where("week = 52"), PRODUCT, "alpha", "beta") == rows(bandit.posterior(arms), PRODUCT, "alpha", "beta")


def test_draws_ignore_order_and_partitions(spark, sold):
    arms = arms_frame(spark, sold)
    once = rows(bandit.draw(arms), PRODUCT, "probability")
    again = rows(bandit.draw(arms.orderBy(F.desc(PRODUCT)).repartition(7)), PRODUCT, "probability")
    assert once == again
    assert once != rows(bandit.draw(arms, seed=43), PRODUCT, "probability")
    assert dict(once)["never"] == 0.0


def test_beta_moments(spark):
    n, a, b = 4000, 3, 9
    draws = spark.range(n).select(
        keyed_beta(F.lit(a), F.lit(b), 1, F.col("id").cast("string")).alias("p")
    ).agg(F.avg("p"), F.var_samp("p")).first()
    mean, var = a / (a + b), a * b / ((a + b) ** 2 * (a + b + 1))
    assert abs(draws[0] - mean) < 5 * math.sqrt(var / n)
    assert abs(draws[1] / var - 1) < 0.15


def test_both_ways_to_find_sold_weeks(spark):
    sales = sales_frame(spark, [("a", "x", 1), ("a", "x", 9), ("b", "x", 1), ("c", "x", 2), ("b", "y", 52), ("gone", "x", 5)])
    stores = stores_frame(spark, STORES)
    small = rows(bandit.arm_weeks(sales, stores), CATEGORY, PRODUCT, "mask")
    assert small == rows(bandit.arm_weeks(sales, stores, broadcast_rows=1), CATEGORY, PRODUCT, "mask")
    assert small == [("bar", "x", 2 + 2**9), ("shop", "x", 2 + 4), ("shop", "y", 2**52)]


def test_zero_category_has_no_shares(spark):
    drawn = spark.createDataFrame(
        [("z", "x", 0.0), ("z", "y", 0.0), ("k", "x", 1.0), ("k", "y", 3.0)], f"{CATEGORY} string, {PRODUCT} string, probability double"
    )
    shares = bandit.category_shares(drawn)
    assert rows(shares.where(f"{CATEGORY} = 'k'"), PRODUCT, "share") == [("x", 0.25), ("y", 0.75)]
    assert shares.where(f"{CATEGORY} = 'z'").where("share IS NOT NULL").count() == 0
    stores = spark.createDataFrame([("s", "p", "z", 1)], "pdv string, premise string, categoria_pdv string, zipcode int")
    forecasts = spark.createDataFrame([("s", *[100.0] * 5)], f"{STORE} string, " + ", ".join(f"{c} double" for c in alloc.HORIZON_COLUMNS))
    assert alloc.allocate(forecasts, shares, stores).count() == 0


def test_allocation_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    stores = [(f"s{i}", "x", "hot" if i % 3 else "cold", 1) for i in range(60)]
    raw = {c: rng.pareto(1.0, 40) for c in ("hot", "cold")}
    share = [(c, f"p{i}", 0.5, float(v / raw[c].sum())) for c in raw for i, v in enumerate(raw[c])]
    share.append(("cold", "half", 0.5, 0.5))
    forecast = [(f"s{i}", *[float(v) for v in np.where(rng.random(5) < 0.3, 0, rng.pareto(0.7, 5) * 5)]) for i in range(60)]
    forecast[0] = ("s0", 2.0, 1.0, 4.0, 0.0, 1.9999)
    expected = sorted(
        (str(h + 1), s[0], p, math.floor(v * f[1 + h]))
        for s, f in zip(stores, forecast, strict=True) for c, p, _, v in share if c == s[2]
        for h in range(5) if math.floor(v * f[1 + h]) > 0
    )
    columns = ", ".join(f"{c} double" for c in alloc.HORIZON_COLUMNS)
    plan = alloc.allocate(
        spark.createDataFrame(forecast, f"{STORE} string, {columns}"),
        spark.createDataFrame(share, f"{CATEGORY} string, {PRODUCT} string, probability double, share double"),
        spark.createDataFrame(stores, "pdv string, premise string, categoria_pdv string, zipcode int"), salts=3,
    )
    assert rows(plan, "semana", "pdv", "produto", "quantidade") == expected
    assert ("1", "s0", "half", 1) in expected


def test_salts_by_category_and_saturated_quantities(spark, monkeypatch):
    """Only a large category is dealt out; a forecast beyond the integers, or a null one, does not fail the plan."""
    monkeypatch.setattr(alloc, "STORES_A_SALT", 10)
    stores = spark.createDataFrame([(f"s{i}", "x", "hot" if i else "cold", 1) for i in range(36)], "pdv string, premise string, categoria_pdv string, zipcode int")
    assert rows(alloc.category_salts(stores), CATEGORY, "salts") == [("cold", 1), ("hot", 4)]
    shares = spark.createDataFrame([("hot", "p", 0.5, 0.5), ("cold", "q", 0.5, 1.0)], f"{CATEGORY} string, {PRODUCT} string, probability double, share double")
    columns = ", ".join(f"{c} double" for c in alloc.HORIZON_COLUMNS)
    forecasts = spark.createDataFrame([("s0", 1e12, None, 0.0, 3.0, 0.5)] + [(f"s{i}", 2.0, 0.0, 0.0, 0.0, 0.0) for i in range(1, 36)], f"{STORE} string, {columns}")
    got = rows(alloc.allocate(forecasts, shares, stores), "semana", "pdv", "produto", "quantidade")
    assert got == sorted([("1", "s0", "q", 2147483647), ("4", "s0", "q", 3)] + [("1", f"s{i}", "p", 1) for i in range(1, 36)])
