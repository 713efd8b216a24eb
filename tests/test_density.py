import numpy as np
import pandas as pd
import pytest
from brute import clusters, core, dist, same_partition, tree
from pyspark.sql import functions as F

from demandloom.operators import density
from demandloom.operators.ordering import running_total
from test_weekly import rows

FEATURES = ("f0", "f1", "f2")


def frame(spark, x):
    data = [(f"k{i:04d}", *map(float, p)) for i, p in enumerate(x)]
    return spark.createDataFrame(data, "pdv string, " + ", ".join(f"f{d} double" for d in range(x.shape[1])))


def cloud(seed, sizes=(40, 60, 30), spread=0.3, noise=30):
    rng = np.random.default_rng(seed)
    groups = [rng.normal(rng.uniform(-4, 4, 3), spread * rng.uniform(0.5, 2), (n, 3)) for n in sizes]
    return np.vstack([*groups, rng.uniform(-5, 5, (noise, 3))])


def by_key(df, column):
    return np.array([r[column] for r in df.orderBy("pdv").collect()])


@pytest.fixture(scope="module")
def spread_out(spark):
    """A cloud cut into many small leaves, so that all searches cross leaves."""
    x = cloud(1)
    return x, density.index_points(frame(spark, x), FEATURES, leaf_points=24)


def test_leaves_are_small_and_whole(spread_out):
    x, s = spread_out
    sizes = [r["count"] for r in s.points.groupBy("leaf").count().collect()]
    assert sum(sizes) == len(x) and max(sizes) <= 24 and s.depth >= 1


def test_neighbour_counts(spread_out):
    x, s = spread_out
    assert np.array_equal(by_key(density.neighbour_counts(s, 0.7), "neighbours"), (dist(x) <= 0.7).sum(axis=1))


@pytest.mark.parametrize("k", [1, 5, 40])
def test_core_distances(spread_out, k):
    x, s = spread_out
    assert np.array_equal(by_key(density.store_core_distances(s, k), "core"), core(x, k))


def test_too_few_keys(spread_out):
    with pytest.raises(ValueError):
        density.core_distances(spread_out[1], 10_000)


@pytest.fixture(scope="module")
def merged(spread_out):
    x, s = spread_out
    return x, density.build_hierarchy(s, 5, 8)


def test_spanning_tree(merged):
    x, h = merged
    expected = sorted((w, *sorted((f"k{i:04d}", f"k{j:04d}"))) for w, i, j in tree(x, 5))
    found = sorted((r["distance"], *sorted((r["from_key"], r["to_key"]))) for r in density.spanning_tree(h).collect())
    # Ties may pick other edges here, because points are numbered by position: weights decide.
    assert [e[0] for e in found] == [e[0] for e in expected]
    assert len(set(found)) == len(x) - 1


@pytest.mark.parametrize("eps", [0.0, 0.5, 0.9, 2.0])
def test_clusters_follow_the_merge_tree(merged, eps):
    x, h = merged
    order = np.lexsort(x.T[::-1])
    found = by_key(density.leaf_clusters(h, 8, eps), "cluster")
    assert same_partition(found[order], clusters(x[order], 5, 8, eps))


def test_components(merged):
    x, h = merged
    found = density.density_components(h, 0.6)
    c = core(x, 5)
    w = np.maximum(dist(x), np.maximum(c[:, None], c[None, :]))
    label = np.arange(len(x))
    while True:
        better = np.array([min([label[j] for j in range(len(x)) if j == i or w[i, j] <= 0.6]) for i in range(len(x))])
        if np.array_equal(better, label):
            break
        label = better
    assert [r["component"] for r in found.orderBy("pdv").collect()] == [f"k{i:04d}" for i in label]
    assert np.array_equal(by_key(found, "is_core"), c <= 0.6)


def test_two_squares_and_an_outlier(spark):
    square = np.array([[i % 3, i // 3] for i in range(9)] + [[1, 3]], dtype=float) * 0.1
    x = np.vstack([square, square + 5, [[20, 20]]])
    s = density.index_points(frame(spark, x), ("f0", "f1"))
    found = by_key(density.leaf_clusters(density.build_hierarchy(s, 4, 6), 6, 0.5), "cluster")
    assert found.tolist() == [0] * 10 + [1] * 10 + [-1]


def test_a_third_of_all_keys_in_one_place(spark):
    """Identical points become one weighted point; the result is that of all pairs."""
    rng = np.random.default_rng(5)
    x = np.vstack([np.zeros((50, 3)), rng.normal(0, 0.3, (40, 3)), rng.normal(4, 0.3, (40, 3)), rng.uniform(-6, 6, (20, 3))])
    s = density.index_points(frame(spark, x), FEATURES, leaf_points=16)
    assert s.points.count() == 101
    assert np.array_equal(by_key(density.store_core_distances(s, 10), "core"), core(x, 10))
    assert np.array_equal(by_key(density.neighbour_counts(s, 0.5), "neighbours"), (dist(x) <= 0.5).sum(axis=1))
    h = density.build_hierarchy(s, 10, 10)
    order = np.lexsort(x.T[::-1])
    found = by_key(density.leaf_clusters(h, 10, 0.2), "cluster")
    assert same_partition(found[order], clusters(x[order], 10, 10, 0.2))
    assert sorted(r["distance"] for r in density.spanning_tree(h).collect()) == [w for w, _, _ in tree(x, 10)]


def test_repeated_coordinates_still_split(spark):
    x = np.array([[i % 2, (i // 2) % 2, i // 4] for i in range(200)], dtype=float)
    s = density.index_points(frame(spark, x), FEATURES, leaf_points=8)
    assert max(r["count"] for r in s.points.groupBy("leaf").count().collect()) <= 8
    assert np.array_equal(by_key(density.store_core_distances(s, 6), "core"), core(x, 6))


def test_no_split_means_all_noise(spark):
    x = np.random.default_rng(2).normal(0, 1, (60, 3))
    s = density.index_points(frame(spark, x), FEATURES, leaf_points=64)
    found = by_key(density.leaf_clusters(density.build_hierarchy(s, 40, 40), 40, 0.5), "cluster")
    assert set(found) == {-1}


def test_clusters_do_not_depend_on_partitions(spark, merged):
    x, h = merged
    other = density.index_points(frame(spark, x).orderBy(F.desc("pdv")).repartition(11), FEATURES, leaf_points=512)
    again = density.leaf_clusters(density.build_hierarchy(other, 5, 8), 8, 0.5)
    assert rows(again, "pdv", "cluster") == rows(density.leaf_clusters(h, 8, 0.5), "pdv", "cluster")


def test_stores_without_features_keep_null(spark):
    stores = spark.createDataFrame([("k0000",), ("none",)], "pdv string")
    labels = spark.createDataFrame([("k0000", -1)], "pdv string, cluster int")
    assert rows(density.with_clusters(stores, labels), "pdv", "cluster", "is_noise") == [("k0000", -1, True), ("none", None, None)]


def test_running_totals_across_partitions(spark):
    rng = np.random.default_rng(0)
    data = [("g" if v % 3 else "h", int(v), int(w)) for v, w in zip(rng.permutation(500), rng.integers(1, 9, 500), strict=True)]
    df = spark.createDataFrame(data, "g string, o int, v long").repartition(9)
    out = running_total(df, ["g"], ["o"], "v", "t", following={"next": "v"})
    expected = []
    for g in ("g", "h"):
        mine = sorted(d for d in data if d[0] == g)
        sums = np.cumsum([d[2] for d in mine]).tolist()
        after = [d[2] for d in mine[1:]] + [None]
        expected += [(g, d[1], t, n) for d, t, n in zip(mine, sums, after, strict=True)]
    assert rows(out, "g", "o", "t", "next") == expected


def test_far_and_own_blocks_are_passed_over(monkeypatch):
    """The cheapest edges equal those of the whole matrix, for a fraction of its distances."""
    from demandloom.operators import density, space

    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3)).repeat(40, 0) + rng.normal(size=(2400, 3)) * 1e-3
    frame = pd.DataFrame({"id": rng.permutation(2400), "x": list(x), "core": np.round(rng.random(2400), 1) * 1e-3, "comp": np.arange(2400) // 40})
    frame["bound"] = 2.0
    w = np.maximum(np.maximum(space.distances(x, x), frame.core.to_numpy()[:, None]), frame.core.to_numpy()[None, :])
    w[frame.comp.to_numpy()[:, None] == frame.comp.to_numpy()[None, :]] = np.inf
    want = []
    for comp in range(60):
        rows = np.flatnonzero(frame.comp == comp)
        ids = frame.id.to_numpy()
        want.append((comp, *min((w[a, b], min(ids[a], ids[b]), max(ids[a], ids[b]), b // 40) for a in rows for b in np.flatnonzero(w[a] <= w[rows].min()))))
    done = []
    monkeypatch.setattr(density, "distances", lambda a, b: done.append(len(a) * len(b)) or space.distances(a, b))
    for q in (frame, frame.drop(columns="bound")):
        done.clear()
        assert [tuple(r) for r in density._cheapest(q, frame).itertuples(index=False)] == [t for t in want if "bound" not in q or t[1] <= 2.0]
        assert sum(done) < 2400 * 2400 / 3
    radius = density._leaf_radius(frame.assign(weight=1), 10)
    assert np.array_equal(radius, np.sort(space.distances(x, x), 1)[:, 9])


def test_points_without_a_place_leave_no_edge():
    place = pd.DataFrame({"id": [1, 2, 3], "x": [np.zeros(3), np.ones(3), np.full(3, np.nan)], "core": [0.5, 0.5, np.nan], "comp": [1, 2, 3]})
    assert density._cheapest(place, place).empty
    assert len(density._cheapest(place[:2], place[:2])) == 2
