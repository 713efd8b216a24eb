"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine >= t are at most eps = sqrt(2 - 2t) apart. Vectors are projected on their leading principal
directions, which never lengthens a distance, and sorted by label and by grid cell (side eps) of these coordinates: the
epsilon grid order. The sorted sequence is cut into intervals of bounded size, and intervals are grouped by ``FANOUT`` to
longer intervals, up to the whole. Starting from (whole, whole), pairs of intervals are replaced by pairs of their parts
as long as their bounding boxes are within eps; all others are provably distant and skipped. Remaining pairs of shortest
intervals are compared by one matrix product each, which sends on link counts and a spanning forest, not pairs.

The principal directions come from sums over all vectors. They decide how much is skipped, never what is found.

Contract: vectors are compared if their labels are equal and not null and their lengths are equal. Vectors that are null,
empty, zero or hold null or non-finite components link with nothing. Equal vectors of one label are compared once and
counted by their number. Rows with a null vec_id are dropped; rows that repeat an id are vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.graph import components
from demandloom.llm.text import batch_of
from demandloom.session import cut

CELLS = 6
BOUNDS = 8
FANOUT = 8
LEAF_ROWS = 512
LEAF_VALUES = 1 << 15


def unit_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None where a vector takes part in nothing."""
    found = []
    for value in column.to_pylist() if column.null_count or _holes(column) else _rows(column):
        if value is None or not len(value) or (isinstance(value, list) and any(v is None for v in value)):
            found.append(None)
            continue
        x = np.asarray(value, np.float64)
        if not np.isfinite(x).all() or not x.any():
            found.append(None)
            continue
        x = x / np.abs(x).max()  # no overflow in the squares
        found.append(x / math.sqrt(float(x @ x)))
    return found


def _holes(column: pa.Array) -> bool:
    return column.flatten().null_count > 0


def _rows(column: pa.Array):
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
    return (values[i:j] for i, j in zip(ends[:-1], ends[1:]))


UNIT = pa.schema([("vec_id", pa.int64()), ("grp", pa.string()), ("dim", pa.int32()), ("unit", pa.binary())])


def _units(batches):
    for batch in batches:
        vectors = unit_vectors(batch.column("embedding"))
        labels = batch.column("label").to_pylist()
        use = [v is not None and lab is not None for v, lab in zip(vectors, labels)]
        yield batch_of(
            UNIT, batch.column("vec_id"),
            [f"{len(v):08d}|{lab}" if u else None for u, v, lab in zip(use, vectors, labels)],
            [len(v) if u else 0 for u, v in zip(use, vectors)],
            [(v + 0.0).tobytes() if u else None for u, v in zip(use, vectors)],
        )


MOMENT = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("value", pa.float64())])


def _moments(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        units = batch.column("unit")
        for d in np.unique(dims):
            x = np.stack([np.frombuffer(units[int(i)].as_buffer(), np.float64) for i in np.flatnonzero(dims == d)])
            full = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
            sums[int(d)] = sums.get(int(d), 0) + full
    for d, full in sums.items():
        yield batch_of(MOMENT, np.full(len(full), d), np.arange(len(full)), full)


def principal_directions(units: DataFrame) -> dict[int, np.ndarray]:
    """Leading directions by vector length. What reaches the driver is as large as the square of the length."""
    rows = units.mapInArrow(_moments, "dim int, at int, value double").groupBy("dim", "at").agg(F.sum("value").alias("value"))
    found: dict[int, dict[int, float]] = {}
    for dim, at, value in rows.collect():
        found.setdefault(dim, {})[at] = value
    result = {}
    for dim, parts in found.items():
        full = np.array([parts[i] for i in range(1 + dim + dim * dim)])
        mean = full[1:1 + dim] / full[0]
        cov = full[1 + dim:].reshape(dim, dim) / full[0] - np.outer(mean, mean)
        _, vectors = np.linalg.eigh(cov)
        result[dim] = np.ascontiguousarray(vectors[:, ::-1][:, :BOUNDS])
    return result


def _placer(directions: dict[int, np.ndarray], eps: float):
    kind = pa.schema([("id", pa.int64()), ("weight", pa.int64()), ("grp", pa.string()), ("unit", pa.binary()),
                      *[(f"c{i}", pa.int32()) for i in range(CELLS)]])

    def run(batches):
        for batch in batches:
            cells = np.zeros((batch.num_rows, CELLS), np.int32)
            for i, u in enumerate(batch.column("unit")):
                x = np.frombuffer(u.as_buffer(), np.float64)
                p = x @ directions[len(x)][:, :CELLS]
                cells[i, :len(p)] = np.floor(p / eps)
            yield batch_of(kind, *[batch.column(c) for c in ("id", "weight", "grp", "unit")],
                           *[np.ascontiguousarray(cells[:, j]) for j in range(CELLS)])
    return run


LEAF = pa.schema([
    ("part", pa.int64()), ("at", pa.int64()), ("grp", pa.string()), ("dim", pa.int32()), ("ids", pa.binary()), ("weights", pa.binary()),
    ("matrix", pa.binary()), *[(f"lo{i}", pa.float64()) for i in range(BOUNDS)], *[(f"hi{i}", pa.float64()) for i in range(BOUNDS)],
])
LEAF_DDL = ("part long, at long, grp string, dim int, ids binary, weights binary, matrix binary, "
            + ", ".join(f"lo{i} double" for i in range(BOUNDS)) + ", " + ", ".join(f"hi{i} double" for i in range(BOUNDS)))


def _intervals(directions: dict[int, np.ndarray]):
    def leaf(part: int, at: int, grp: str, rows: list) -> pa.RecordBatch:
        x = np.stack([np.frombuffer(r[2], np.float64) for r in rows])
        p = x @ directions[x.shape[1]]
        lo, hi = np.zeros(BOUNDS), np.zeros(BOUNDS)
        lo[:p.shape[1]], hi[:p.shape[1]] = p.min(0), p.max(0)
        return batch_of(
            LEAF, [part], [at], [grp], [x.shape[1]], [np.array([r[0] for r in rows], np.int64).tobytes()],
            [np.array([r[1] for r in rows], np.int64).tobytes()], [x.tobytes()], *[[v] for v in lo], *[[v] for v in hi],
        )

    def run(batches):
        part = TaskContext.get().partitionId()
        at, grp, rows = 0, None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "weight", "unit", "grp"))):
                full = rows and len(rows) >= min(LEAF_ROWS, max(16, LEAF_VALUES * 8 // len(row[2])))
                if rows and (row[3] != grp or full):
                    yield leaf(part, at, grp, rows)
                    at, rows = at + 1, []
                grp = row[3]
                rows.append(row[:3])
        if rows:
            yield leaf(part, at, grp, rows)
    return run


FOUND = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])


def _compare(cosine: float):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                get = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                a, b = get("ids_a", np.int64), get("ids_b", np.int64)
                x, y = get("matrix_a", np.float64).reshape(-1, dim), get("matrix_b", np.float64).reshape(-1, dim)
                near = x @ y.T
                links = near >= cosine
                for r, c in np.argwhere(np.abs(near - cosine) < 1e-12):
                    links[r, c] = math.fsum(x[r] * y[c]) >= cosine
                own = batch.column("a")[i].as_py() == batch.column("b")[i].as_py()
                if own:
                    np.fill_diagonal(links, False)
                if not links.any():
                    continue
                wa, wb = get("weights_a", np.int64), get("weights_b", np.int64)
                left, right = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
                part = links[np.ix_(left, right)]
                # smallest id reachable by links of this pair of intervals
                far = np.iinfo(np.int64).max
                la, lb = a[left], b[right]
                while True:
                    nb = np.minimum(lb, np.where(part, la[:, None], far).min(0))
                    na = np.minimum(la, np.where(part, nb[None, :], far).min(1))
                    if (na == la).all() and (nb == lb).all():
                        break
                    la, lb = na, nb
                yield batch_of(FOUND, a[left], part @ wb[right], la)
                if not own:
                    yield batch_of(FOUND, b[right], wa[left] @ part, lb)
    return run


def near_embeddings(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-9
    vectors = vectors.where("vec_id IS NOT NULL").select("vec_id", "embedding", F.col("label"))
    units = cut(vectors.mapInArrow(_units, "vec_id long, grp string, dim int, unit binary")
                .withColumn("same", F.sha2("unit", 256)))
    used = units.where("grp IS NOT NULL")
    classes = cut(used.groupBy("grp", "same").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("unit").alias("unit")))
    directions = principal_directions(used)
    ddl = "id long, weight long, grp string, unit binary, " + ", ".join(f"c{i} int" for i in range(CELLS))
    order = ["grp", *[f"c{i}" for i in range(CELLS)], "id"]
    placed = classes.select("id", "weight", "grp", "unit").mapInArrow(_placer(directions, eps), ddl)
    leaves = cut(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_intervals(directions), LEAF_DDL))
    before = leaves.groupBy("part").agg(F.count("*").alias("k")).withColumn(
        "before", F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    leaves = cut(leaves.join(before, "part").withColumn("seq", F.col("at") + F.coalesce("before", F.lit(0))).drop("part", "at", "k", "before"))
    pairs = cut(_close_intervals(leaves, eps))
    blob = ["ids", "weights", "matrix"]
    left = leaves.select(F.col("seq").alias("a"), "dim", *[F.col(c).alias(f"{c}_a") for c in blob])
    right = leaves.select(F.col("seq").alias("b"), *[F.col(c).alias(f"{c}_b") for c in blob])
    found = cut(pairs.join(left, "a").join(right, "b").mapInArrow(_compare(cosine), "id long, n long, root long"))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = (
        classes.drop("unit").join(counts, "id", "left").join(linked.withColumnRenamed("node", "id"), "id", "left")
        .select("grp", "same", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("c"))
    )
    return units.select("vec_id", "grp", "same").join(classes, ["grp", "same"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("c", "vec_id")).alias("kept"),
    )


def _close_intervals(leaves: DataFrame, eps: float) -> DataFrame:
    """Pairs (a <= b) of shortest intervals whose boxes are within eps, found from the whole sequence downwards."""
    spark = leaves.sparkSession
    bounds = [f"{k}{i}" for i in range(BOUNDS) for k in ("lo", "hi")]
    base = leaves.select("seq", F.col("grp").alias("g0"), F.col("grp").alias("g1"), *bounds)
    size = base.count()
    depth = max(1, math.ceil(math.log(max(size, 2), FANOUT) - 1e-9))
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for level in range(depth - 1, -1, -1):
        wide = FANOUT ** level
        nodes = base.groupBy(F.floor(F.col("seq") / wide).alias("node")).agg(
            F.min("g0").alias("g0"), F.max("g1").alias("g1"),
            *[(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in bounds],
        ).withColumn("up", F.floor(F.col("node") / FANOUT))
        x = nodes.select(*[F.col(c).alias(f"x_{c}") for c in nodes.columns])
        y = nodes.select(*[F.col(c).alias(f"y_{c}") for c in nodes.columns])
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"x_lo{i}") - F.col(f"y_hi{i}"), F.col(f"y_lo{i}") - F.col(f"x_hi{i}")), 2)
                   for i in range(BOUNDS)), F.lit(0.0))
        near = (F.col("x_node") <= F.col("y_node")) & (F.col("x_g0") <= F.col("y_g1")) & (F.col("y_g0") <= F.col("x_g1")) & (gap <= eps * eps)
        pairs = pairs.join(x, pairs["a"] == x["x_up"]).join(y, F.col("b") == F.col("y_up")).where(near).select(
            F.col("x_node").alias("a"), F.col("y_node").alias("b"))
        if level and level % 3 == 0:
            pairs = cut(pairs)
    return pairs
