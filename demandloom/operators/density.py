"""Density clustering of stores: core distances, the reachability tree and its clusters.

The method is HDBSCAN with leaf selection (Campello et al. 2013; Malzer & Baum 2020). The
minimum spanning tree is built by Borůvka rounds, and the same rounds yield the merge
hierarchy: an edge joins the merge chain of the first component, at a later round, whose
own cheapest edge is dearer. Edges are ordered by (weight, low id, high id), so tree and
clusters are unique.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators import space
from demandloom.operators.ordering import running_total
from demandloom.operators.profile import CLUSTER_FEATURES
from demandloom.operators.space import distances, matrix
from demandloom.session import cut

UNPLACED = -2
NOISE = -1
EDGE = ("w", "i", "j")


@dataclass
class Space:
    """Distinct points in leaves, the key -> point map, dimensions and tree depth."""

    points: DataFrame
    members: DataFrame
    dims: int
    depth: int


def index_points(scaled: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, key: str = "pdv",
                 leaf_points: int = space.LEAF_POINTS) -> Space:
    points, members = space.distinct_points(scaled, features, key)
    placed = cut(space.split_leaves(points, len(features), leaf_points))
    return Space(placed, cut(members), len(features), space.tree_depth(placed))


# ------------------------------------------------------------------ neighbours

def _crossing(s: Space, radius: str, points: DataFrame) -> DataFrame | None:
    """Queries (id, x, radius, target) to other leaves that a point's ball touches."""
    if s.depth == 0:
        return None
    leaves = cut(points.groupBy("leaf").agg(*space.box_columns(s.dims), F.max(radius).alias("reach")))
    pairs = space.near_leaves(leaves, space.tree_levels(leaves, s.depth, s.dims), s.dims, "reach")
    boxes = leaves.select(F.col("leaf").alias("target"), "low", "high")
    routes = space.small_side(cut(pairs.join(boxes, "target")))
    gap = space.point_gap(F.col("x"), F.col("low"), F.col("high"), s.dims)
    return points.join(routes, "leaf").where(space.within(gap, F.col(radius))).select("id", "x", radius, "target")


def neighbour_counts(s: Space, epsilon: float) -> DataFrame:
    """Per key: how many keys lie within ``epsilon``, itself included.

    Counts are formed next to the points; pairs are never written out.
    """
    def count(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        near = distances(matrix(q), matrix(p)) <= epsilon
        return pd.DataFrame({"id": q["id"], "n": near @ p["weight"].to_numpy()})

    own = s.points.groupBy("leaf").applyInPandas(lambda p: count(p, p), "id long, n long")
    queries = _crossing(s, "reach0", s.points.withColumn("reach0", F.lit(float(epsilon))))
    parts = own if queries is None else own.unionByName(
        space.visit(cut(queries), s.points.select("leaf", "x", "weight"), count, "id long, n long")
    )
    totals = parts.groupBy("id").agg(F.sum("n").alias("neighbours"))
    return s.members.join(totals, "id").drop("id")


def _nearest(q: pd.DataFrame, p: pd.DataFrame, k: int, radius: np.ndarray) -> pd.DataFrame:
    """Per query the (up to k) nearest points within its radius: distances and weights.

    A block of neighbouring queries is held against the blocks of points that the widest of its radii reaches.
    """
    x, y, weights = matrix(q), matrix(p), p["weight"].to_numpy()
    asking, offered = space.compact(x), space.compact(y)
    lows, highs = space.boxes(y, offered)
    ids, d_of, n_of = [], [], []
    for rows in asking:
        gap = space.box_distances(x[rows].min(0), x[rows].max(0), lows, highs)
        met = [offered[b] for b in np.flatnonzero(~(gap > radius[rows].max() * (1 + space.SLACK)))]
        columns = np.concatenate(met) if met else np.zeros(0, np.int64)
        d = distances(x[rows], y[columns])
        keep = min(k, len(columns))
        order = np.argpartition(d, keep - 1, axis=1)[:, :keep] if keep < len(columns) else np.tile(np.arange(keep), (len(rows), 1))
        near = np.take_along_axis(d, order, axis=1)
        inside, own = near <= radius[rows][:, None], weights[columns[order]]
        ids.append(q["id"].to_numpy()[rows])
        d_of += [row[ok] for row, ok in zip(near, inside, strict=True)]
        n_of += [row[ok] for row, ok in zip(own, inside, strict=True)]
    return pd.DataFrame({"id": np.concatenate(ids) if ids else np.zeros(0, np.int64), "d": d_of, "n": n_of})


def _leaf_radius(p: pd.DataFrame, k: int) -> np.ndarray:
    """Distance to the k-th key inside the leaf; infinite when the leaf has fewer."""
    x, weights = matrix(p), p["weight"].to_numpy()
    if weights.sum() < k:
        return np.full(len(p), np.inf)
    keep, out = min(k, len(p)), []
    for at in range(0, len(x), space.BLOCK_POINTS):
        d = distances(x[at:at + space.BLOCK_POINTS], x)
        some = np.argpartition(d, keep - 1, axis=1)[:, :keep]
        near = np.take_along_axis(d, some, axis=1)
        order = np.argsort(near, axis=1, kind="stable")
        reached = np.cumsum(np.take_along_axis(weights[some], order, axis=1), axis=1) >= k
        out.append(np.take_along_axis(np.take_along_axis(near, order, axis=1), reached.argmax(axis=1)[:, None], axis=1)[:, 0])
    return np.concatenate(out)


def core_distances(s: Space, k: int) -> DataFrame:
    """Points with ``core``: the distance to the k-th key, counting the point itself.

    The leaf gives an upper bound. Only points whose ball of that radius leaves the leaf
    ask other leaves, which answer with at most k distances inside the radius.
    """
    total = s.points.agg(F.sum("weight")).first()[0] or 0
    if k < 1 or total < k:
        raise ValueError(f"a {k}-th neighbour needs at least {max(k, 1)} keys; there are {total}")

    def bound(p: pd.DataFrame) -> pd.DataFrame:
        return p.assign(radius=_leaf_radius(p, k))

    schema = "id long, x array<double>, weight long, first_key string, leaf string, radius double"
    columns = [c.split()[0] for c in schema.split(", ")]
    bounded = cut(s.points.select(*columns[:-1]).groupBy("leaf").applyInPandas(
        lambda p: bound(p)[columns], schema
    ))
    if s.depth:
        # A leaf with too few keys borrows the diagonal of its nearest large enough ancestor.
        leaves = cut(bounded.groupBy("leaf").agg(*space.box_columns(s.dims), F.sum("weight").alias("keys")))
        levels = space.tree_levels(leaves, s.depth, s.dims, [F.sum("keys").alias("keys")])
        enough = reduce(DataFrame.unionByName, [
            n.where(F.col("keys") >= k).select("node", space.diagonal(F.col("low"), F.col("high"), s.dims).alias("wide"))
            for n in levels
        ])
        prefixes = leaves.select("leaf", F.explode(F.transform(
            F.sequence(F.lit(0), F.length("leaf")), lambda t: F.substring(F.col("leaf"), F.lit(1), t))).alias("node"))
        wide = prefixes.join(enough.distinct(), "node").groupBy("leaf").agg(F.min("wide").alias("wide"))
        bounded = bounded.join(wide, "leaf").withColumn("radius", F.least("radius", "wide")).drop("wide")
    queries = _crossing(s, "radius", bounded)
    if queries is None:
        return bounded.withColumnRenamed("radius", "core")
    queries = cut(queries)
    open_points = queries.select("id").distinct()
    asking = bounded.join(open_points, "id", "left_semi").select("id", "x", "radius", F.col("leaf").alias("target"))
    answers = space.visit(
        queries.unionByName(asking), s.points.select("leaf", "x", "weight"),
        lambda q, p: _nearest(q, p, k, q["radius"].to_numpy()), "id long, d array<double>, n array<long>",
    )
    pairs = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("d", "n"))))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("core"))
    kth = F.aggregate("pairs", start, lambda acc, p: F.struct(
        (acc["seen"] + p["n"]).alias("seen"),
        F.when(acc["core"].isNull() & (acc["seen"] + p["n"] >= k), p["d"]).otherwise(acc["core"]).alias("core"),
    ))
    merged = answers.groupBy("id").agg(pairs.alias("pairs")).select("id", kth["core"].alias("merged"))
    return bounded.join(merged, "id", "left").withColumn("core", F.coalesce("merged", "radius")).drop("merged", "radius")


def store_core_distances(s: Space, k: int) -> DataFrame:
    return s.members.join(core_distances(s, k).select("id", "core"), "id").drop("id")


# ------------------------------------------------------------------ Borůvka rounds

def _cheapest(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
    """Per component of the queries its cheapest edge to a point of another component.

    Blocks of neighbours are compared, the nearest first; a block that is farther than what the components of the queries have
    found, or of the same component, is passed over.
    """
    columns = ["comp", "w", "i", "j", "other"]
    p = p.sort_values("id")
    for wrong in p.loc[np.isnan(matrix(p)).any(1) | p["core"].isna(), "comp"].unique():  # no edge past a point without a place
        q = q[q["comp"] == wrong]
    if q.empty:
        return pd.DataFrame({c: [] for c in columns}).astype({c: "float64" if c == "w" else "int64" for c in columns})
    x, mine, core, (names, comp) = matrix(q), q["id"].to_numpy(), q["core"].to_numpy(), np.unique(q["comp"].to_numpy(), return_inverse=True)
    y, theirs, cores, comps = matrix(p), p["id"].to_numpy(), p["core"].to_numpy(), p["comp"].to_numpy()
    none = np.iinfo(np.int64).max
    best = {"w": np.full(len(names), np.inf), **{c: np.full(len(names), none) for c in columns[2:]}}
    if "bound" in q:  # their components know an edge of this weight
        best["w"][comp] = np.nan_to_num(q["bound"].to_numpy(), nan=np.inf) * (1 + space.SLACK)
    offered = [np.sort(b) for b in space.compact(y)]  # in id order, so the first minimum of a row is also the smallest edge
    lows, highs = space.boxes(y, offered)
    least = np.array([cores[b].min() for b in offered])
    only = np.array([comps[b[0]] if (comps[b] == comps[b[0]]).all() else -1 for b in offered])
    for rows in space.compact(x):
        own = comp[rows]
        gap = np.maximum(np.maximum(space.box_distances(x[rows].min(0), x[rows].max(0), lows, highs), least), core[rows].min())
        single = names[own[0]] if (own == own[0]).all() else -2
        for b in np.argsort(gap, kind="stable"):
            if gap[b] > best["w"][own].max() * (1 + space.SLACK):
                break
            if only[b] == single:
                continue
            block = offered[b]
            w = distances(x[rows], y[block])
            np.maximum(w, core[rows][:, None], out=w)
            np.maximum(w, cores[block][None, :], out=w)
            w[names[own][:, None] == comps[block][None, :]] = np.inf
            at = w.argmin(axis=1)
            low = w[np.arange(len(rows)), at]
            use = np.flatnonzero(np.isfinite(low) & (low <= best["w"][own]))
            if not len(use):
                continue
            to = block[at[use]]
            edge = {"w": low[use], "i": np.minimum(mine[rows[use]], theirs[to]), "j": np.maximum(mine[rows[use]], theirs[to]), "other": comps[to]}
            order = np.lexsort((edge["j"], edge["i"], edge["w"], own[use]))
            place = own[use][order]
            first = np.concatenate([[True], place[1:] != place[:-1]])
            order, place = order[first], place[first]
            w, i, j = (edge[c][order] for c in EDGE)
            w0, i0, j0 = (best[c][place] for c in EDGE)
            better = (w < w0) | ((w == w0) & ((i < i0) | ((i == i0) & (j < j0))))
            for c in columns[1:]:
                best[c][place[better]] = edge[c][order][better]
    found = best["i"] < none
    return pd.DataFrame({"comp": names[found], **{c: best[c][found] for c in columns[1:]}})


EDGES = "comp long, w double, i long, j long, other long"


def _best_edges(s: Space, points: DataFrame) -> DataFrame:
    """Cheapest outgoing edge of every component, exact under (w, i, j).

    A first bound per component comes from its own leaves: an edge inside a mixed leaf, or
    the extent of the smallest tree node around it that holds another component. Then only
    points whose core distance is within the bound look into other leaves, and only
    leaves within the bound that hold something else.
    """
    def inside(p: pd.DataFrame) -> pd.DataFrame:
        return _cheapest(p, p)

    mixed = points.join(
        points.groupBy("leaf").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi"),
        "leaf", "left_semi",
    )
    local = mixed.select("leaf", "id", "x", "core", "comp").groupBy("leaf").applyInPandas(inside, EDGES)
    pick = F.min(F.struct(*EDGE, "other")).alias("best")
    if s.depth == 0:
        return local.groupBy("comp").agg(pick).select("comp", "best.*")
    local = cut(local)
    leaves = cut(points.groupBy("leaf").agg(
        *space.box_columns(s.dims), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.min("core").alias("near"), F.max("core").alias("far"),
    ))
    levels = space.tree_levels(leaves, s.depth, s.dims, [
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("near").alias("near"), F.max("far").alias("far"),
    ])
    spread = reduce(DataFrame.unionByName, [
        n.where("lo < hi").select(
            "node", F.greatest(space.diagonal(F.col("low"), F.col("high"), s.dims), F.col("far")).alias("wide"))
        for n in levels
    ]).distinct()
    prefixes = leaves.where("lo = hi").select(F.col("lo").alias("comp"), F.explode(F.transform(
        F.sequence(F.lit(0), F.length("leaf")), lambda t: F.substring(F.col("leaf"), F.lit(1), t))).alias("node"))
    bounds = cut(
        prefixes.join(spread, "node").select("comp", F.col("wide").alias("bound"))
        .unionByName(local.select("comp", F.col("w").alias("bound")))
        .groupBy("comp").agg(F.min("bound").alias("bound"))
    )
    ready = points.join(bounds, "comp").where(F.col("core") <= F.col("bound") * (1 + space.SLACK))
    seekers = cut(ready.select("id", "x", "core", "comp", "leaf", "bound"))
    reach = seekers.groupBy("leaf").agg(F.max("bound").alias("reach"))
    searching = leaves.join(reach, "leaf")
    pairs = space.near_leaves(
        searching, levels, s.dims, "reach",
        lambda: (F.col("b.near") <= F.col("a.reach") * (1 + space.SLACK))
        & ~((F.col("a.lo") == F.col("a.hi")) & (F.col("b.lo") == F.col("b.hi")) & (F.col("a.lo") == F.col("b.lo"))),
    )
    boxes = leaves.select(F.col("leaf").alias("target"), "low", "high", "lo", "hi", "near")
    routes = space.small_side(cut(pairs.join(boxes, "target")))
    gap = space.point_gap(F.col("x"), F.col("low"), F.col("high"), s.dims)
    queries = seekers.join(routes, "leaf").where(
        space.within(gap, F.col("bound")) & (F.col("near") <= F.col("bound") * (1 + space.SLACK))
        & ~((F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("comp")))
    ).select("id", "x", "core", "comp", "bound", "target")
    across = space.visit(cut(queries), points.select("leaf", "id", "x", "core", "comp"), _cheapest, EDGES)
    return local.unionByName(across).groupBy("comp").agg(pick).select("comp", "best.*")


def _follow(links: DataFrame, key: str, to: str) -> DataFrame:
    """Replace every link by the end of its path (an end links to itself).

    Each round goes three links further than the last, so paths shrink to a third.
    """
    current = cut(links)
    while True:
        one = current.select(F.col(key).alias("via"), F.col(to).alias("next"))
        two = current.select(F.col(key).alias("next"), F.col(to).alias("end"))
        moved = cut(current.join(one, F.col(to) == F.col("via")).join(two, "next").select(
            key, F.col("end").alias(to), (F.col("end") != F.col(to)).alias("moved")
        ))
        current = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return current


@dataclass
class Hierarchy:
    """The merge hierarchy.

    ``nodes``: one row per tree edge: its chain (level, comp), weight, the keys it adds
    (``gain``) and how many large components it receives besides its chain (``kids``).
    ``chains``: per component of a round its keys and the edge (w, i, j) that ends it.
    """

    nodes: DataFrame
    chains: DataFrame
    points: DataFrame
    members: DataFrame


def build_hierarchy(s: Space, k: int, min_size: int = 2) -> Hierarchy:
    """Borůvka rounds over mutual reachability. ``k`` sets the core distance."""
    points = cut(core_distances(s, k).withColumn("comp", F.col("id")))
    sizes = points.select("comp", F.col("weight").alias("size"))
    pending, closed, chains, level = None, [], [], 0
    while True:
        best = cut(_best_edges(s, points))
        if best.isEmpty():
            if pending is not None:
                closed.append(pending.select(F.lit(level).alias("level"), "comp", *EDGE, "gain", "kids"))
            last = sizes if pending is None else pending.groupBy("comp").agg(F.sum("gain").alias("size"))
            chains.append(cut(last.select(
                F.lit(level).alias("level"), "comp", "size", *[F.lit(None).cast(t).alias(c) for c, t in
                                                              (("w", "double"), ("i", "long"), ("j", "long"))]
            )))
            break
        if pending is not None:
            # An edge cheaper than its component's next one ends in that component's chain.
            tested = cut(pending.join(
                best.select("comp", F.struct(*EDGE).alias("next")), "comp"
            ).withColumn("ends", F.struct(*EDGE) < F.col("next")).drop("next"))
            done = tested.where("ends").drop("ends")
            closed.append(done.select(F.lit(level).alias("level"), "comp", *EDGE, "gain", "kids"))
            pending = tested.where(~F.col("ends")).drop("ends")
            sizes = done.groupBy("comp").agg(F.sum("gain").alias("size"))
        chosen = cut(best.join(sizes, "comp"))
        chains.append(chosen.select(F.lit(level).alias("level"), "comp", "size", *EDGE))
        # Each tree of choices has one edge chosen from both ends; its smaller end is the root.
        back = chosen.select(F.col("comp").alias("there"), F.col("i").alias("bi"), F.col("j").alias("bj"))
        links = chosen.join(back, F.col("other") == F.col("there")).select(
            "comp",
            F.when((F.col("i") == F.col("bi")) & (F.col("j") == F.col("bj")) & (F.col("comp") < F.col("other")), F.col("comp"))
            .otherwise(F.col("other")).alias("to"),
        )
        moves = space.small_side(_follow(links, "comp", "to"))
        fresh = chosen.join(moves, "comp").groupBy(*EDGE).agg(
            F.any_value("to").alias("comp"), F.sum("size").alias("gain"),
            F.count_if(F.col("size") >= min_size).alias("kids"),
        )
        if pending is not None:
            moved = pending.join(moves, "comp").withColumn("comp", F.col("to")).drop("to")
            fresh = fresh.unionByName(moved.select(*fresh.columns))
        pending = cut(fresh)
        points = cut(points.join(moves, "comp").withColumn("comp", F.col("to")).drop("to"))
        level += 1
    empty = points.sparkSession.createDataFrame(
        [], "level int, comp long, w double, i long, j long, gain long, kids long"
    )
    nodes = reduce(DataFrame.unionByName, closed, empty)
    return Hierarchy(nodes, reduce(DataFrame.unionByName, chains), points, s.members)


def spanning_tree(h: Hierarchy) -> DataFrame:
    """Edges of the reachability tree between representative keys.

    Keys at the same position form one point; they are tied to its first key by their
    core distance.
    """
    names = h.points.select("id", "first_key", "core")
    between = (
        h.nodes.join(names.select(F.col("id").alias("i"), F.col("first_key").alias("from_key")), "i")
        .join(names.select(F.col("id").alias("j"), F.col("first_key").alias("to_key")), "j")
        .select("from_key", "to_key", F.col("w").alias("distance"))
    )
    key = [c for c in h.members.columns if c != "id"][0]
    same = h.members.join(names, "id").where(F.col(key) != F.col("first_key")).select(
        F.col("first_key").alias("from_key"), F.col(key).alias("to_key"), F.col("core").alias("distance")
    )
    return between.unionByName(same)


# ------------------------------------------------------------------ clusters

def _chain_positions(h: Hierarchy, min_size: int) -> DataFrame:
    """Tree edges with their component's size, whether they split, and their segment.

    A split joins two components of at least ``min_size`` keys. Splits cut a chain into
    segments 0, 1, ..; a segment is (part of) one cluster.
    """
    chain = ["level", "comp"]
    sized = running_total(h.nodes, chain, EDGE, "gain", "size")
    marked = sized.withColumn(
        "split",
        (F.col("kids") + F.when(F.col("size") - F.col("gain") >= min_size, 1).otherwise(0) >= 2).cast("long"),
    )
    return cut(running_total(marked, chain, EDGE, "split", "segment"))


def density_components(h: Hierarchy, epsilon: float) -> DataFrame:
    """Components joined by reachability up to ``epsilon``, named by their first key.

    A key whose core distance exceeds epsilon stays alone and is not a core key.
    """
    home = h.nodes.select(F.struct("level", "comp").alias("chain"), "i", "j")
    ends = h.chains.select(F.struct("level", "comp").alias("chain"), *EDGE)
    links = (
        ends.where(F.col("w") <= epsilon).select("chain", "i", "j")
        .join(home.withColumnRenamed("chain", "to"), ["i", "j"], "left").select("chain", "to")
        .unionByName(ends.where(F.col("w").isNull() | (F.col("w") > epsilon)).select("chain", F.col("chain").alias("to")))
    )
    tops = _follow(links, "chain", "to")
    start = h.points.select(
        "id", "first_key", "core",
        F.struct(F.lit(0).alias("level"), F.col("id").alias("comp")).alias("chain"),
    )
    placed = start.join(tops, "chain")
    names = placed.groupBy("to").agg(F.min("first_key").alias("component"))
    return h.members.join(placed.select("id", "core", "to"), "id").join(names, "to").select(
        *[c for c in h.members.columns if c != "id"], "component", (F.col("core") <= epsilon).alias("is_core")
    )


def leaf_clusters(h: Hierarchy, min_size: int, epsilon: float = 0.0) -> DataFrame:
    """Cluster number per key, or -1.

    Clusters are the leaves of the split tree. A leaf that split off below ``epsilon`` is
    replaced by its nearest ancestor that split off above it, or by the ancestor next to
    the root; the root itself is never a cluster. Numbers follow the clusters' first keys.
    """
    key = [c for c in h.members.columns if c != "id"][0]
    nodes = _chain_positions(h, min_size)
    seg = F.struct("level", "comp", "segment").alias("seg")
    root_schema = "struct<level:int,comp:bigint,segment:bigint>"

    # Every chain ends in an edge of another chain, except the last one.
    ends = h.chains.join(
        nodes.select("i", "j", seg.alias("into"), (F.col("split") == 1).alias("at_split")), ["i", "j"], "left"
    ).select("level", "comp", "w", "into", "at_split")
    tops = nodes.groupBy("level", "comp").agg(F.max("segment").alias("segment"))
    last = ends.join(tops, ["level", "comp"], "left").select(
        F.struct("level", "comp", F.coalesce("segment", F.lit(0)).alias("segment")).alias("seg"), "w", "into", "at_split"
    )
    # Lower segments of a chain end in its own next split.
    inner = nodes.where((F.col("split") == 1) & (F.col("size") > F.col("gain"))).select(
        F.struct("level", "comp", (F.col("segment") - 1).alias("segment")).alias("seg"),
        "w", seg.alias("into"), F.lit(True).alias("at_split"),
    )
    segments = cut(last.unionByName(inner))
    heads = segments.where(F.col("at_split") | F.col("into").isNull())
    links = segments.select("seg", F.when(F.col("at_split") | F.col("into").isNull(), F.col("seg")).otherwise(
        F.col("into")).alias("cluster"))
    home = _follow(links, "seg", "cluster")

    clusters = cut(heads.join(
        home.select(F.col("seg").alias("into"), F.col("cluster").alias("parent")), "into", "left"
    ).select(F.col("seg").alias("cluster"), "parent", F.col("w").alias("birth")))
    parents = clusters.where("parent IS NOT NULL").select(F.col("parent").alias("cluster")).distinct()
    roots = clusters.where("parent IS NULL").select(F.col("cluster").alias("parent"), F.lit(True).alias("below_root"))
    tree = (
        clusters.join(parents.withColumn("inner", F.lit(True)), "cluster", "left")
        .join(roots, "parent", "left")
        .select("cluster", "parent", "birth", F.col("inner").isNull().alias("leaf"),
                F.col("below_root").isNotNull().alias("below_root"))
    )
    # Small segments never split off anything; only heads that did are clusters.
    split_off = tree.where("parent IS NOT NULL")
    stop = F.col("below_root") | (F.col("birth") > epsilon) | (F.col("leaf") & (F.col("birth") >= epsilon))
    climb = split_off.select("cluster", F.when(stop, F.col("cluster")).otherwise(F.col("parent")).alias("to"))
    reached = _follow(climb, "cluster", "to")
    selected = cut(split_off.where("leaf").join(reached, "cluster").select(F.col("to").alias("cluster")).distinct())
    upward = tree.join(selected.withColumn("chosen", F.lit(True)), "cluster", "left").select(
        "cluster",
        F.when(F.col("chosen") | F.col("parent").isNull(), F.col("cluster")).otherwise(F.col("parent")).alias("label"),
    )
    labels = _follow(upward, "cluster", "label").join(
        selected.withColumnRenamed("cluster", "label"), "label", "left_semi"
    )
    vertex = F.struct(F.lit(0).alias("level"), F.col("id").alias("comp"), F.lit(0).cast("long").alias("segment"))
    placed = cut(
        h.points.select("id", "first_key", vertex.cast(root_schema).alias("seg"))
        .join(home, "seg").join(labels, "cluster").select("id", "first_key", "label")
    )
    named = placed.groupBy("label").agg(F.min("first_key").alias("first_key")).withColumn("one", F.lit(1).cast("long"))
    numbers = running_total(named, [], ["first_key"], "one", "number").select(
        "label", (F.col("number") - 1).cast("int").alias("cluster")
    )
    out = h.members.join(placed.join(numbers, "label").select("id", "cluster"), "id", "left")
    return out.select(key, F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))


def with_clusters(stores: DataFrame, labels: DataFrame) -> DataFrame:
    """Stores with their cluster number; stores without features keep null."""
    return stores.join(labels, "pdv", "left").withColumn("is_noise", F.col("cluster") == NOISE)


def store_clusters(stores: DataFrame, scaled: DataFrame, min_size: int = 100, epsilon: float = 0.5,
                   neighbours: int | None = None, features: Sequence[str] = CLUSTER_FEATURES,
                   leaf_points: int = space.LEAF_POINTS) -> DataFrame:
    """The whole clustering in one call.

    Stores with a missing feature (no zip) have no place among the others; they share the label ``UNPLACED``. Only
    stores without sales, which have no features at all, keep null.
    """
    s = index_points(scaled.dropna(subset=list(features)), features, leaf_points=leaf_points)
    h = build_hierarchy(s, neighbours or min_size, min_size)
    missing = scaled.where(F.greatest(*[F.col(c).isNull() for c in features])).select("pdv", F.lit(UNPLACED).alias("cluster"))
    return with_clusters(stores, leaf_clusters(h, min_size, epsilon).unionByName(missing))
