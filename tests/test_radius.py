"""Neighbours and components within one radius against all pairs."""

import numpy as np
import pytest
from brute import dist
from pyspark.sql import functions as F

from demandloom.operators import radius
from demandloom.operators.contract import components
from test_density import FEATURES, by_key, cloud, frame


def brute_components(x, eps, k):
    near = dist(x) <= eps
    core = near.sum(1) >= k
    label = np.arange(len(x))
    while True:
        low = np.array([min([label[j] for j in np.flatnonzero(near[i] & core)] + [label[i]]) if core[i] else label[i] for i in range(len(x))])
        if (low == label).all():
            return label, core
        label = low


@pytest.fixture(params=["cloud", "crowd", "equal", "line"])
def points(request):
    rng = np.random.default_rng(5)
    if request.param == "cloud":
        return cloud(3)
    if request.param == "crowd":  # a cell of several chunks, beside sparse ones
        return np.vstack([rng.normal(0, 0.05, (260, 3)), rng.uniform(-3, 3, (60, 3))])
    if request.param == "equal":
        return np.repeat(rng.uniform(-1, 1, (12, 3)), rng.integers(1, 30, 12), axis=0)
    return np.array([[0.6 * i, 0.0, -0.3 * i] for i in range(150)])  # a chain through many cells


def test_counts_and_components(spark, points):
    df = frame(spark, points).repartition(5)
    for eps, k in ((0.7, 4), (0.3, 2)):
        got = by_key(radius.neighbour_counts(df, FEATURES, eps), "neighbours")
        assert np.array_equal(got, (dist(points) <= eps).sum(axis=1))
        label, core = brute_components(points, eps, k)
        found = radius.density_components(df, FEATURES, eps, k)
        assert found.count() == len(points)
        assert np.array_equal(by_key(found, "is_core"), core)
        assert by_key(found, "component").tolist() == [f"k{i:04d}" for i in label]


def test_small_chunks_meet_once(spark, points):
    df = radius.weighted_points(frame(spark, points), FEATURES)
    made = radius.chunks(df, FEATURES, 0.7, size=7)
    total, most = made.agg(F.sum(F.size("ids")), F.max(F.size("ids"))).first()
    assert total == len(np.unique(points, axis=0)) and most <= 7
    near = dist(points) <= 0.7
    got = dict(radius.point_counts(df, FEATURES, 0.7, size=7).collect())
    assert all(got[f"k{i:04d}"] == near[i].sum() for i in range(len(points)) if f"k{i:04d}" in got) and len(got) == len(np.unique(points, axis=0))


def test_points_without_a_place_and_no_points(spark):
    df = frame(spark, cloud(2)).withColumn("f1", F.when(F.col("pdv") != "k0003", F.col("f1")))
    assert radius.neighbour_counts(df, FEATURES, 0.5).where("pdv = 'k0003'").count() == 0
    assert radius.neighbour_counts(df.limit(0), FEATURES, 0.5).count() == 0
    assert radius.density_components(df.limit(0), FEATURES, 0.5, 3).count() == 0


def test_contraction(spark):
    rng = np.random.default_rng(6)
    links = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)] + [(f"m{a}", f"m{b}") for a, b in rng.integers(0, 60, (50, 2))]
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        parent[root(a)] = root(b)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a string, b string")).collect()))
    want = {}
    for a in {n for link in links for n in link if link[0] != link[1]}:
        want.setdefault(root(a), set()).add(a)
    groups = {}
    for node, name in got.items():
        groups.setdefault(name, set()).add(node)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_blocks_far_apart_or_wholly_within_are_not_compared(monkeypatch):
    rng = np.random.default_rng(7)
    x, y = rng.uniform(0, 0.1, (40, 4)), np.vstack([rng.uniform(0.1, 0.2, (30, 4)), rng.uniform(5, 5.1, (20, 4))])
    w, v = rng.integers(1, 4, 40), rng.integers(1, 4, 50)
    near = np.linalg.norm(x[:, None] - y[None], axis=2) <= 0.5
    asked = []
    monkeypatch.setattr(radius, "distances", lambda a, b: asked.append(len(a) * len(b)) or np.linalg.norm(a[:, None] - b[None], axis=2))
    found, back = radius._near(x, np.array([0, 20]), w, y, np.array([0, 30]), v, 0.5)
    assert found.tolist() == (near @ v).tolist() and back.tolist() == (w @ near).tolist() and not asked
    found, back = radius._near(x, np.array([0, 20]), w, y, np.array([0, 15]), v, 0.5)  # a block of both kinds
    assert found.tolist() == (near @ v).tolist() and back.tolist() == (w @ near).tolist() and sum(asked) == 40 * 35


def test_dense_chunks_settle_by_a_few_pairs(spark, tmp_path, monkeypatch):
    """In a crowd only the points that lack neighbours in their own chunk, and pairs that may join components, are compared."""
    rng = np.random.default_rng(8)
    x = np.vstack([rng.uniform(0, 0.3, (400, 3)), rng.uniform(3, 3.2, (40, 3)), [[9.0, 9.0, 9.0]]])
    points = radius.weighted_points(frame(spark, x), FEATURES)
    monkeypatch.setattr(radius, "CHUNK_POINTS", 20)
    found = radius.chunks(points, FEATURES, 0.6, size=20, join=True)
    pairs = radius.chunk_pairs(found, 3, 0.6).count()
    compared = []
    whole = radius._compared
    monkeypatch.setattr(radius, "_compared", lambda p, *rest: compared.append(p.count()) or whole(p, *rest))
    links = radius.group_links(found, 3, 0.6)
    assert len(compared) == 2 and compared[0] <= 14 * found.count() and sum(compared) < pairs - found.count()
    assert len({r["component"] for r in components(links).collect()}) == 2
    core = radius.core_points(points, FEATURES, 0.6, 5, size=20)
    assert core.where("is_core").count() == 440 and core.count() == 441
