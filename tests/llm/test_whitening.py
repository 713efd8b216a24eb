"""Whitening against numpy's eigenvectors and exact whole-number arithmetic."""

import math

import numpy as np
import pandas as pd
import pytest

from demandloom.llm import whitening


def expected(vectors, most=16):
    """(model values by brute force) of one length: n, sums, eigenvalues, eigenvectors, trace."""
    whole = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(whole))
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    x = np.array(fit, np.float64)
    centred = x - np.array(sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return whole, n, sums, values[::-1][:most], basis[:, ::-1][:, :most], values.sum()


def compare(spark, vectors, most=16):
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = whitening.whiten(rows, whitening.fit_whitening(rows, most)).toPandas().sort_values(["component", "vec_id"])
    vectors = [np.float32(v) for v in vectors]
    whole, n, sums, values, basis, trace = expected(vectors, most)
    assert set(got["n"]) == {n}
    for component, part in got.groupby("component"):
        part = part.sort_values("vec_id")
        assert part["deviation"].tolist() == [sum((n * a - s) ** 2 for a, s in zip(w, sums)) for w in whole]
        want = (np.array(whole) - np.array(sums) / n) @ basis[:, component - 1] / math.sqrt(values[component - 1])
        sign = np.sign(want @ part["whitened"].to_numpy())
        np.testing.assert_allclose(part["whitened"], sign * want, atol=1e-8)
        np.testing.assert_allclose(part["explained"], values[component - 1] / trace, rtol=1e-9)
    assert got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    return got


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 24)) * np.linspace(0.2, 3, 24)
    vectors = np.concatenate([vectors, vectors[:50], np.repeat(vectors[:1], 200, 0)])  # copies count once
    got = compare(spark, vectors)
    assert len(got) == 550 * 16


def test_fewer_dimensions_than_components(spark):
    got = compare(spark, np.random.default_rng(2).normal(size=(40, 3)))
    assert sorted(set(got["component"])) == [1, 2, 3]


@pytest.mark.parametrize("values", [
    [5.0, 4.0, 3.0, 2.0, 1.0], [1.0, 1.0, 1.0, 1.0], [3.0, 3.0, 1.0, 1.0, 1.0, 0.0], [2.0, 0.0, -2.0], [1e9, 1.0, 1e-6], [0.0, 0.0],
    [1.0 + 1e-13, 1.0, 0.5], list(np.linspace(1, 2, 64)),
])
def test_divide_and_conquer(values):
    """Also repeated eigenvalues, an eigenvalue equal to the shift, wide ranges and the zero matrix."""
    m = len(values)
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((m, m)))[0]
    a = q * np.array(values) @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.leading_components(a, m)
    scale = max(abs(v) for v in values) or 1.0
    np.testing.assert_allclose(found, sorted(values, reverse=True), atol=1e-13 * scale * m)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(m), atol=1e-13 * m)
    np.testing.assert_allclose(a @ vectors, vectors * found, atol=1e-13 * scale * m)
    few, _ = whitening.leading_components(a, 2)
    np.testing.assert_allclose(few, sorted(values, reverse=True)[:2], atol=1e-13 * scale * m)


def test_polar_factor():
    a = np.random.default_rng(4).standard_normal((30, 30))
    a = a + a.T
    u = whitening.polar(a)
    values, vectors = np.linalg.eigh(a)
    np.testing.assert_allclose(u, vectors * np.sign(values) @ vectors.T, atol=1e-12)


def test_odd_rows(spark):
    """Nulls, non-finite and too large entries, empty vectors, other lengths, repeated and null ids, clashing columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 5.0]), (2, [2.0, -4.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1e30, 1.0]), (8, []), (9, [7.0]), (10, [7.0]), (11, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], "vec_id long, embedding array<double>, x string, dim int")
    got = whitening.whiten(df, whitening.fit_whitening(df)).toPandas()
    counts = got["vec_id"].value_counts(dropna=False)
    assert counts[1] == 4 and counts[2] == 2 and counts[9] == 1 and counts[11] == 3 and got["vec_id"].isna().sum() == 2
    assert not set(got["vec_id"].dropna()) & {3, 4, 5, 6, 7, 8}
    pair = got[got["vec_id"] == 2]
    assert set(pair["n"]) == {3} and pair["identity_error"].max() < 1e-12 and pair["whitened"].notna().all()
    alone = got[got["vec_id"] == 9]  # one distinct vector: no variance
    assert alone["whitened"].isna().all() and alone["identity_error"].isna().all() and alone["deviation"].tolist() == [0]
    empty = df.limit(0)
    assert whitening.whiten(empty, whitening.fit_whitening(empty)).count() == 0


def test_exact_sums_of_large_entries(spark):
    """Sums beyond a long stay exact; a deviation beyond a long is null."""
    big = 2.0**55
    df = spark.createDataFrame([(i, [big, float(i)]) for i in range(300)] + [(300, [-big, 1.0])], "vec_id long, embedding array<double>")
    centre = whitening.centres(whitening.whole_vectors(df).select("dim", "x").distinct())[2]
    assert centre.n == 301 and centre.sums == [299 * 2**61, 64 * (sum(range(300)) + 1)]
    got = whitening.whiten(df, whitening.fit_whitening(df)).toPandas()
    assert got["deviation"].isna().all()


def test_rows_in_any_layout(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(200, 8)))], "vec_id long, embedding array<float>")
    one = whitening.whiten(df, whitening.fit_whitening(df.coalesce(1))).toPandas()
    many = whitening.whiten(df, whitening.fit_whitening(df.repartition(7))).toPandas()
    both = pd.merge(one, many, on=["vec_id", "component"])
    for _, part in both.groupby("component"):
        sign = np.sign(part["whitened_x"] @ part["whitened_y"])
        np.testing.assert_allclose(part["whitened_x"], sign * part["whitened_y"], atol=1e-9)
