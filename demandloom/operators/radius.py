"""Neighbours within one radius, and the components they form, by a grid of cells as wide as the radius.

Points go into cells by their three widest dimensions. Sorted by cell, and inside by cells of all dimensions, they are cut into
chunks: a crowded cell is several chunks and a sparse one a small chunk; neighbours can only lie in the same cell or one of its 26
neighbours. Each chunk is sent to its own and 13 of these cells, so a pair of chunks meets once, and only if their boxes are within
the radius. A chunk holds blocks of neighbouring points: a pair of blocks that is too far is passed over, one that lies within the
radius as a whole is counted at once, the others are compared by a matrix of distances. Equal points are one point with a weight.
What leaves a comparison are counts per point, or links between groups already joined inside chunks.

Components need no counts, only who is dense: most points are settled by their own chunk, and the others alone are compared with the
chunks about them. Of the pairs of chunks, a few per chunk are linked first; after that only pairs that may still join different
components are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.contract import components
from demandloom.operators.space import SLACK, box_gap, compact, distances
from demandloom.session import cut

GRID_DIMS = 3
CHUNK_POINTS = 512
BLOCK_POINTS = 64
CELL = ("c0", "c1", "c2")
PLACE = ("part", "at")
STEPS = list(product((-1, 0, 1), repeat=len(CELL)))
HALF = [s for s in STEPS if s >= (0,) * len(CELL)]  # own cell and half of the others

LISTS = {"ids": pa.string(), "weights": pa.int64(), "matrix": pa.float64(), "starts": pa.int32(), "label": pa.int32()}
CHUNK = pa.schema([*[(c, pa.int64()) for c in (*CELL, *PLACE)], *[(c, pa.list_(t)) for c, t in LISTS.items()],
                   ("own", pa.list_(pa.int64())), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
CHUNK_DDL = ("c0 long, c1 long, c2 long, part long, at long, ids array<string>, weights array<long>, matrix array<double>, starts array<int>, "
             "label array<int>, own array<long>, low array<double>, high array<double>")


def weighted_points(scaled: DataFrame, features: Sequence[str], key: str = "pdv") -> DataFrame:
    """Distinct points (features, id, weight); the id is the first key there. Keys without a place are left out."""
    return scaled.dropna(subset=list(features)).groupBy(*features).agg(F.min(key).alias("id"), F.count("*").alias("weight"))


def widest(points: DataFrame, features: Sequence[str]) -> list[str]:
    """The dimensions of the grid."""
    spread = points.agg(*[(F.max(f) - F.min(f)).alias(f) for f in features]).first()
    return sorted(features, key=lambda f: -(spread[f] or 0.0))[:GRID_DIMS]


def _groups(near: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the links of a symmetric matrix."""
    label = np.arange(len(near))
    while True:
        low = np.where(near, label[None, :], len(near)).min(1, initial=len(near))
        low = np.minimum(label, low)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _bounds(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)


def _reach(x, starts, y, other, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of x, blocks of y): whether a pair lies within ``epsilon`` as a whole, and whether it has to be compared."""
    (low, high), (lows, highs) = _bounds(x, starts), _bounds(y, other)
    up, down = highs[None] - low[:, None], high[:, None] - lows[None]
    farthest = np.sqrt((np.maximum(up, down) ** 2).sum(2))
    nearest = np.sqrt((np.maximum(np.maximum(-up, -down), 0.0) ** 2).sum(2))
    whole = farthest <= epsilon * (1 - SLACK)
    return whole, ~whole & (nearest <= epsilon * (1 + SLACK))


def _stretches(size: int, starts: np.ndarray) -> list[np.ndarray]:
    return np.split(np.arange(size), starts[1:])


def _near(x, starts, weights, y, other, other_weights, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys of y within ``epsilon`` of each point of x, and keys of x within it of each point of y."""
    whole, partly = _reach(x, starts, y, other, epsilon)
    blocks, others = _stretches(len(x), starts), _stretches(len(y), other)
    found = np.repeat(whole @ np.add.reduceat(other_weights, other), [len(b) for b in blocks])
    back = np.repeat(np.add.reduceat(weights, starts) @ whole, [len(b) for b in others])
    w, v = weights.astype(float), other_weights.astype(float)  # sums of counts stay exact
    for block, compared in zip(blocks, partly):
        if compared.any():
            columns = np.concatenate([others[j] for j in np.flatnonzero(compared)])
            near = (distances(x[block], y[columns]) <= epsilon).astype(float)
            found[block] += (near @ v[columns]).astype(np.int64)
            back[columns] += (w[block] @ near).astype(np.int64)
    return found, back


def _chunks(dims: int, epsilon: float, join: bool, count: bool, size: int):
    def chunk(part: int, at: int, cell, ids, weights, x) -> pa.RecordBatch:
        blocks = compact(x, BLOCK_POINTS)
        order = np.concatenate(blocks)
        starts = np.cumsum([0] + [len(b) for b in blocks[:-1]])
        x, weights, ids = x[order], np.array(weights, np.int64)[order], [ids[i] for i in order.tolist()]
        label = _groups(distances(x, x) <= epsilon) if join else np.zeros(0, np.int32)
        own = _near(x, starts, weights, x, starts, weights, epsilon)[0] if count else np.zeros(0, np.int64)
        columns = [*[[c] for c in cell], [part], [at], [ids], [weights], [np.ravel(x)], [starts], [label], [own], [x.min(0)], [x.max(0)]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CHUNK)], schema=CHUNK)

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        last, ids, weights, rows = None, [], [], []
        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy() for c in CELL], 1)
            x = batch.column("x").flatten().to_numpy().reshape(-1, dims)
            edges = np.flatnonzero((cells[1:] != cells[:-1]).any(1)) + 1
            for begin, end in zip(np.concatenate([[0], edges]), np.concatenate([edges, [len(cells)]])):
                if begin == end:
                    continue
                cell = tuple(int(c) for c in cells[begin])
                for low in range(int(begin), int(end), size):
                    high = min(low + size, int(end))
                    if ids and (cell != last or len(ids) + high - low > size):
                        yield chunk(part, at, last, ids, weights, np.concatenate(rows))
                        at, ids, weights, rows = at + 1, [], [], []
                    last = cell
                    ids += batch.column("id").slice(low, high - low).to_pylist()
                    weights += batch.column("weight").slice(low, high - low).to_pylist()
                    rows.append(x[low:high])
        if ids:
            yield chunk(part, at, last, ids, weights, np.concatenate(rows))
    return run


def chunks(points: DataFrame, features: Sequence[str], epsilon: float, join: bool = False, size: int = CHUNK_POINTS,
           count: bool = False, grid: Sequence[str] | None = None) -> DataFrame:
    """Chunks of at most ``size`` points in cell order; with ``join`` the points of a chunk are labelled by the links among them, with
    ``count`` each has the keys of its chunk within ``epsilon``.
    """
    grid = widest(points, features) if grid is None else grid
    side = epsilon * (1 + 1e-9) or 1.0  # rounding must not part two cells that touch
    cells = [F.floor(F.col(f) / side).cast("long").alias(c) for f, c in zip(grid, CELL)]
    cells += [F.lit(0).cast("long").alias(c) for c in CELL[len(cells):]]
    fine = [F.floor(F.col(f) / side) for f in features if f not in grid] + [F.floor(F.col(f) * 2 / side) for f in features]
    placed = points.select(*cells, F.array(*fine).alias("fine"), "id", "weight", F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    order = (*CELL, "fine", F.xxhash64("id"))
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("fine")
    return cut(ordered.mapInArrow(_chunks(len(features), epsilon, join, count, size), CHUNK_DDL))


def meet(found: DataFrame, others: DataFrame, steps: Sequence[tuple], dims: int, epsilon: float, rest: Sequence[str]) -> DataFrame:
    """Pairs of chunks whose cells are a step apart and whose boxes are within ``epsilon``, as columns a_*, b_*, step and gap."""
    step = F.explode(F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for v, c in zip(s, CELL)]) for s in steps])).alias("step")
    kept = (*PLACE, "low", "high", *rest)
    a = found.select(*CELL, *[F.col(c).alias(f"a_{c}") for c in kept]).select("*", step).select(
        *[(F.col(c) + F.col(f"step.{c}")).alias(c) for c in CELL], F.col("step").alias("step"), *[f"a_{c}" for c in kept])
    b = others.select(*CELL, *[F.col(c).alias(f"b_{c}") for c in kept])
    gap = box_gap(F.col("a_low"), F.col("a_high"), F.col("b_low"), F.col("b_high"), dims)
    return a.join(b, list(CELL)).withColumn("gap", gap).where(F.col("gap") <= epsilon * epsilon * (1 + SLACK) ** 2).select(
        "step", "gap", *[f"{s}_{c}" for s in "ab" for c in (*PLACE, *rest)])


def own_step():
    return (F.col("step.c0") == 0) & (F.col("step.c1") == 0) & (F.col("step.c2") == 0)


def place(side: str):
    return F.struct(*[F.col(f"{side}_{c}") for c in PLACE])


def chunk_pairs(found: DataFrame, dims: int, epsilon: float) -> DataFrame:
    """Each pair of chunks in the same or touching cells once, as columns a_* and b_*; a chunk with itself has ``same``."""
    return meet(found, found, HALF, dims, epsilon, LISTS).where(~own_step() | (place("a") <= place("b"))).select(
        (own_step() & (place("a") == place("b"))).alias("same"), *[f"{s}_{c}" for s in "ab" for c in LISTS])


def _rows(batch: pa.RecordBatch):
    """(same, ids, weights, matrix, starts, label of a, and of b) for every pair."""
    def parts(name):
        column = batch.column(name)
        return column.flatten(), column.offsets.to_numpy() - (column.offsets[0].as_py() if len(column.offsets) else 0)

    columns = {f"{s}_{c}": parts(f"{s}_{c}") for s in "ab" for c in LISTS}
    numbers = {k: v[0].to_numpy() for k, v in columns.items() if not k.endswith("ids")}
    for i, same in enumerate(batch.column("same").to_pylist()):
        out = [same]
        for s in "ab":
            cut_ = {c: slice(columns[f"{s}_{c}"][1][i], columns[f"{s}_{c}"][1][i + 1]) for c in LISTS}
            ids = columns[f"{s}_ids"][0][cut_["ids"]]
            out += [ids, numbers[f"{s}_weights"][cut_["weights"]], numbers[f"{s}_matrix"][cut_["matrix"]].reshape(len(ids), -1),
                    numbers[f"{s}_starts"][cut_["starts"]], numbers[f"{s}_label"][cut_["label"]]]
        yield out


def _counts(epsilon: float, both: bool = True):
    kind = pa.schema([("id", pa.string()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for same, ids, weights, x, starts, _, other, other_weights, y, other_starts, _ in _rows(batch):
                found, back = _near(x, starts, weights, y, other_starts, other_weights, epsilon)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.int64())], schema=kind)
                if both and not same:
                    yield pa.RecordBatch.from_arrays([other, pa.array(back, pa.int64())], schema=kind)
    return run


def point_counts(points: DataFrame, features: Sequence[str], epsilon: float, size: int = CHUNK_POINTS) -> DataFrame:
    """(id, n): keys within ``epsilon`` of each point, its own included."""
    pairs = chunk_pairs(chunks(points, features, epsilon, size=size), len(features), epsilon)
    return pairs.mapInArrow(_counts(epsilon), "id string, n long").groupBy("id").agg(F.sum("n").alias("n"))


def neighbour_counts(scaled: DataFrame, features: Sequence[str], epsilon: float, key: str = "pdv") -> DataFrame:
    """Per key: how many keys lie within ``epsilon``, itself included."""
    points = cut(weighted_points(scaled, features, key))
    counted = points.join(point_counts(points, features, epsilon), "id").select(*features, F.col("n").alias("neighbours"))
    return scaled.join(counted, list(features)).select(key, "neighbours")


def core_points(points: DataFrame, features: Sequence[str], epsilon: float, k: int, size: int = CHUNK_POINTS) -> DataFrame:
    """``points`` with ``is_core``: at least ``k`` keys lie within ``epsilon``, its own included. Points that have them in their own chunk
    are not compared with others.
    """
    grid = widest(points, features)
    found = chunks(points, features, epsilon, size=size, count=True, grid=grid)
    inside = found.select(F.inline(F.arrays_zip("ids", "own"))).toDF("id", "own").groupBy("id").agg(F.sum("own").alias("own"))
    counted = cut(points.join(inside, "id"))
    unsettled = chunks(counted.where(F.col("own") < k), features, epsilon, size=size, grid=grid)
    pairs = meet(unsettled, found, STEPS, len(features), epsilon, LISTS).withColumn("same", F.lit(False))
    exact = pairs.mapInArrow(_counts(epsilon, both=False), "id string, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counted.join(exact, "id", "left").withColumn("is_core", F.coalesce("n", "own") >= k).drop("n", "own")


def _links(epsilon: float):
    kind = pa.schema([("a", pa.string()), ("b", pa.string())])

    def run(batches):
        for batch in batches:
            for _, ids, _, x, starts, label, other, _, y, other_starts, other_label in _rows(batch):
                whole, partly = _reach(x, starts, y, other_starts, epsilon)
                others = _stretches(len(y), other_starts)
                most, pairs = len(np.unique(label)) * len(np.unique(other_label)), np.zeros((0, 2), np.int64)
                for block, asked in zip(_stretches(len(x), starts), whole | partly):
                    if asked.any() and len(pairs) < most:  # until all groups are linked
                        columns = np.concatenate([others[j] for j in np.flatnonzero(asked)])
                        rows, at = np.nonzero(distances(x[block], y[columns]) <= epsilon)
                        pairs = np.unique(np.concatenate([pairs, np.stack([label[block][rows], other_label[columns][at]], 1)]), axis=0)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(pairs[:, 0])), other.take(pa.array(pairs[:, 1]))], schema=kind)
    return run


def _compared(pairs: DataFrame, dense: DataFrame, epsilon: float) -> DataFrame:
    """Links (a, b) of pairs of chunks that are named by their places."""
    for s in "ab":
        pairs = pairs.join(dense.select(*[F.col(c).alias(f"{s}_{c}") for c in (*PLACE, *LISTS)]), [f"{s}_{c}" for c in PLACE])
    shown = pairs.select(F.lit(False).alias("same"), *[f"{s}_{c}" for s in "ab" for c in LISTS])
    return cut(shown.mapInArrow(_links(epsilon), "a string, b string"))


def group_links(dense: DataFrame, dims: int, epsilon: float) -> DataFrame:
    """Links between the groups of different chunks, enough of them for all components."""
    places = [f"{s}_{c}" for s in "ab" for c in PLACE]
    groups = F.array_distinct(F.transform("label", lambda i: F.col("ids")[i]))
    thin = cut(dense.select(*CELL, *PLACE, "low", "high", groups.alias("groups")))
    pairs = cut(meet(thin, thin, HALF, dims, epsilon, ()).where(~own_step() | (place("a") < place("b"))))
    first = cut(pairs.groupBy("a_part", "a_at", "step").agg(F.min(F.struct("gap", "b_part", "b_at")).alias("b")).select(
        "a_part", "a_at", "b.b_part", "b.b_at"))  # at most 14 a chunk
    links = _compared(first, dense, epsilon)
    joined = thin.select(*PLACE, F.explode("groups").alias("node")).join(components(links), "node", "left")
    joined = cut(joined.groupBy(*PLACE).agg(F.collect_set(F.coalesce("component", "node")).alias("now")))  # bounded by a chunk's points
    rest = pairs.select(*places).join(first, places, "left_anti")
    for s in "ab":
        rest = rest.join(joined.select(*[F.col(c).alias(f"{s}_{c}") for c in (*PLACE, "now")]), [f"{s}_{c}" for c in PLACE])
    rest = rest.where(F.size(F.array_union("a_now", "b_now")) > 1).select(*places)
    return links.union(_compared(rest, dense, epsilon))


def density_components(scaled: DataFrame, features: Sequence[str], epsilon: float, k: int, key: str = "pdv") -> DataFrame:
    """(key, component, is_core): core keys have ``k`` keys within ``epsilon``, itself included; core keys within ``epsilon`` of each
    other share a component, named by its first key. Other keys stay alone.
    """
    points = cut(weighted_points(scaled, features, key))
    counted = cut(core_points(points, features, epsilon, k))
    dense = chunks(counted.where("is_core"), features, epsilon, join=True)
    links = group_links(dense, len(features), epsilon)
    # the first point of a chunk's group stands for it
    member = dense.select(F.inline(F.arrays_zip("ids", F.transform("label", lambda i: F.col("ids")[i])))).toDF("id", "node")
    member = cut(member).join(components(links), "node", "left").select("id", F.coalesce("component", "node").alias("group"))
    member = cut(member)
    names = member.groupBy("group").agg(F.min("id").alias("component"))
    labelled = counted.join(member.join(names, "group"), "id", "left").select(*features, "component", "is_core")
    return scaled.join(labelled, list(features)).select(key, F.coalesce("component", F.col(key)).alias("component"), "is_core")
