"""Whitening of embeddings, with principal components by QDWH spectral divide-and-conquer.

Every entry c becomes the whole number x = floor(64 c) + 1000000. The model is fitted on the list of distinct x vectors: Spark
counts and sums them exactly, then sums products of the centred vectors. What reaches the driver is the covariance, as large as
the square of a vector's length, whatever the number of rows. There the matrix, shifted by the mean of its eigenvalues, goes
through a polar decomposition by the QR-based dynamically weighted Halley iteration (QDWH). The orthogonal factor has eigenvalue
1 above the shift and -1 below, so it gives projectors on two invariant subspaces; each is split again until it holds one
component, or only equal eigenvalues. Parts that lie below the components asked for are left alone. The rows are then whitened
in place by the fitted vectors, which Spark sends to every task.

Contract: rows whose vector is null or holds null or non-finite entries go, and so do those with an entry of 2**56 or more, for
which x is no long. Vectors of different lengths are data sets of their own, each with its model; empty vectors have no
components and give no rows. Repeated rows and rows with a null or repeated vec_id all stay as rows, and count once in the fit.
A component without variance (fewer distinct vectors than components, constant dimensions) is returned with whitened null and
takes no part in identity_error, which is null if there is no other. ``deviation`` is null where it exceeds a long. Components
of equal variance come in any order, the same for all rows. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.text import batch_of
from demandloom.session import cut

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**56
EPS = float(np.finfo(np.float64).eps)

VECTORS = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("x", pa.binary())])
COUNTS = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("value", pa.decimal128(38, 0))])
MOMENTS = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("value", pa.float64())])
WHITE = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
    ("explained", pa.float64()), ("identity_error", pa.float64()),
])
WHITE_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- whole-number vectors -------------------------------------------------------------------------------------------

def _pack(rows: np.ndarray) -> list[bytes]:
    """Each row in the narrowest whole-number type that holds it, so equal vectors are equal bytes."""
    low, high = rows.min(1), rows.max(1)
    packed = [b""] * len(rows)
    left = np.ones(len(rows), bool)
    for kind in (np.int16, np.int32, np.int64):
        limits = np.iinfo(kind)
        fits = left & (low >= limits.min) & (high <= limits.max)
        for i, row in zip(np.flatnonzero(fits), rows[fits].astype(kind)):
            packed[i] = row.tobytes()
        left &= ~fits
    return packed


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x - SHIFT as int64 matrix) for every length in a batch of packed vectors."""
    dims = batch.column("dim").to_numpy()
    column = batch.column("x")
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        out = np.empty((len(rows), dim), np.int64)
        for i, row in enumerate(rows):
            raw = column[int(row)].as_buffer()
            out[i] = np.frombuffer(raw, f"i{raw.size // dim}")
        yield int(dim), rows, out


def _whole(batches):
    for batch in batches:
        column = batch.column("embedding")
        lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy().astype(np.int64)
        values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become nan
        ends = np.cumsum(np.maximum(lengths, 0))
        bad = np.concatenate([[0], np.cumsum(~(np.abs(values) < LARGEST))])  # nan and infinities are not below
        good = (lengths > 0) & (bad[ends] == bad[ends - np.maximum(lengths, 0)])
        for dim in np.unique(lengths[good]):
            rows = np.flatnonzero(good & (lengths == dim))
            entries = values[(ends[rows] - dim)[:, None] + np.arange(dim)]
            yield batch_of(VECTORS, batch.column("vec_id").take(pa.array(rows)), np.full(len(rows), dim),
                           _pack(np.floor(SCALE * entries).astype(np.int64)))


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, x) of all rows that have a whole-number vector; x is stored less SHIFT."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(_whole, "vec_id long, dim int, x binary")


# ---- sums -----------------------------------------------------------------------------------------------------------

def _counts(batches):
    """Number of vectors (at -1) and exact sums of x - SHIFT by position."""
    sums: dict[int, list] = {}
    for batch in batches:
        for dim, rows, x in _matrices(batch):
            high, low = (x >> 31).sum(0), (x & (2**31 - 1)).sum(0)
            count, total = sums.get(dim, (0, np.zeros(dim, object)))
            sums[dim] = [count + len(rows), total + high.astype(object) * 2**31 + low.astype(object)]
    for dim, (count, total) in sums.items():
        yield batch_of(COUNTS, np.full(dim + 1, dim), np.arange(-1, dim),
                       pa.array([Decimal(int(v)) for v in [count, *total]], pa.decimal128(38, 0)))


@dataclass
class Centre:
    """Number of vectors and their exact sums, of x - SHIFT."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the whole part is taken off exactly."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over positions of (n x - S)**2."""
        moved = x - self.whole
        most = (int(np.abs(moved).max(initial=0)) + 1) * self.n
        if most**2 * x.shape[1] < 2**63:
            return (((moved * self.n - self.rest) ** 2).sum(1)).tolist()
        exact = ((moved.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1)
        return [int(v) if v < 2**63 else None for v in exact]


def centres(fit: DataFrame) -> dict[int, Centre]:
    rows = fit.mapInArrow(_counts, "dim int, at int, value decimal(38,0)").groupBy("dim", "at").agg(F.sum("value").alias("value"))
    found: dict[int, dict[int, int]] = {}
    for dim, at, value in rows.collect():  # one number per position
        found.setdefault(dim, {})[at] = int(value)
    return {dim: Centre(parts[-1], [parts[i] for i in range(dim)]) for dim, parts in found.items()}


def _products(project):
    """Sums of products of ``project(dim, x)``, by place in the matrix."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _matrices(batch):
                y = project(dim, x)
                sums[dim] = sums.get(dim, 0) + y.T @ y
        for dim, total in sums.items():
            flat = np.ravel(total)
            yield batch_of(MOMENTS, np.full(len(flat), dim), np.arange(len(flat)), flat)
    return run


def covariances(fit: DataFrame, centre: dict[int, Centre], project) -> dict[int, np.ndarray]:
    """Covariance (divisor n) of what ``project`` makes of the fit list; projections must have mean 0."""
    rows = fit.mapInArrow(_products(project), "dim int, at int, value double").groupBy("dim", "at").agg(F.sum("value").alias("value"))
    found: dict[int, dict[int, float]] = {}
    for dim, at, value in rows.collect():  # as many numbers as the matrix has
        found.setdefault(dim, {})[at] = value
    result = {}
    for dim, parts in found.items():
        size = math.isqrt(len(parts))
        full = np.array([parts[i] for i in range(size * size)]).reshape(size, size) / centre[dim].n
        result[dim] = (full + full.T) / 2
    return result


# ---- QDWH spectral divide-and-conquer -------------------------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the QR-based dynamically weighted Halley iteration."""
    m = len(a)
    eye = np.eye(m)
    x = a / np.linalg.norm(a)
    corner = np.abs(np.diag(np.linalg.qr(x, mode="r"))).min()
    low = float(np.clip(corner / m, EPS / m, 0.9))  # towards the least singular value; the iteration only needs its size
    for _ in range(40):
        square = low * low
        root = (4 * (1 - square) / square**2) ** (1 / 3)
        wide = math.sqrt(1 + root)
        p = wide + math.sqrt(max(8 - 4 * root + 8 * (2 - square) / (square * wide), 0.0)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        basis = np.linalg.qr(np.vstack([math.sqrt(r) * x, eye]))[0]
        new = q / r * x + (p - q / r) / math.sqrt(r) * (basis[:m] @ basis[m:].T)
        new = (new + new.T) / 2
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved < 10 * EPS * math.sqrt(m) or (1 - low < 10 * EPS and moved < EPS ** (1 / 3)):
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[float, int, np.ndarray] | None:
    """Orthonormal basis whose first columns span the eigenvectors above ``shift``: (residual, their number, basis)."""
    m = len(a)
    projector = (polar(a - shift * np.eye(m)) + np.eye(m)) / 2
    above = round(float(np.trace(projector)))
    if not 0 < above < m:
        return None
    span = np.linalg.qr(projector @ rng.standard_normal((m, above)))[0]
    span = np.linalg.qr(projector @ span)[0]
    basis = np.linalg.qr(span, mode="complete")[0]
    return float(np.linalg.norm(basis[:, above:].T @ a @ basis[:, :above])), above, basis


def leading_components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit eigenvectors as columns."""
    scale = float(np.linalg.norm(a))
    rng = np.random.default_rng(0)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    todo = [np.eye(len(a))]  # invariant subspaces, the highest eigenvalues on top
    while todo and len(values) < most:
        basis = todo.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        m = len(part)
        mean = float(np.trace(part)) / m
        spread = float(np.linalg.norm(part - mean * np.eye(m)))
        if m == 1 or spread <= 4 * m * EPS * scale:  # one component, or equal eigenvalues: any basis will do
            order = np.argsort(-np.diag(part), kind="stable")
            values += [float(part[i, i]) for i in order]
            vectors += [basis[:, i] for i in order]
            continue
        # The mean lies strictly between the eigenvalues. If one is too close to it, a shift beside it splits better.
        best = None
        for step in (0.0, 0.11, -0.13, 0.29, -0.31, 0.53, -0.59):
            found = _split(part, mean + step * spread / math.sqrt(m), rng)
            if found and (best is None or found[0] < best[0]):
                best = found
            if best and best[0] <= 4 * m * EPS * scale:
                break
        if best is None:  # no shift tells them apart: equal to working accuracy
            values += [mean] * m
            vectors += list(basis.T)
            continue
        _, above, inner = best
        todo += [basis @ inner[:, above:], basis @ inner[:, :above]]
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.stack([vectors[i] for i in order], axis=1)


# ---- model ----------------------------------------------------------------------------------------------------------

@dataclass
class Components:
    """Whitening of the vectors of one length."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def __post_init__(self):
        floor = len(self.vectors) * EPS * max(float(self.values.max(initial=0.0)), 0.0)
        self.alive = self.values > max(floor, 0.0)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows by component; nan where the component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (self.centre.centred(x) @ self.vectors) / np.sqrt(np.where(self.alive, self.values, np.nan))
        return out


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> dict[int, Components]:
    """Model by vector length, learned from the distinct vectors."""
    fit = cut(whole_vectors(embeddings).select("dim", "x").distinct())
    centre = centres(fit)
    found = covariances(fit, centre, lambda dim, x: centre[dim].centred(x))
    model = {}
    for dim, cov in found.items():
        values, vectors = leading_components(cov, min(components, dim))
        model[dim] = Components(centre[dim], values, vectors, float(np.trace(cov)))
    white = covariances(fit, centre, lambda dim, x: np.nan_to_num(model[dim].whiten(x)))
    for dim, cov in white.items():
        alive = model[dim].alive
        if alive.any():
            model[dim].identity_error = float(np.abs(cov - np.eye(len(cov)))[np.ix_(alive, alive)].max())
    return model


def whiten(embeddings: DataFrame, model: dict[int, Components]) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    def run(batches):
        for batch in batches:
            for dim, rows, x in _matrices(batch):
                part = model[dim]
                k = len(part.values)
                white = np.ravel(part.whiten(x))
                explained = np.where(part.alive, part.values, 0.0) / part.trace if part.trace > 0 else np.full(k, np.nan)
                yield batch_of(
                    WHITE, batch.column("vec_id").take(pa.array(np.repeat(rows, k))), np.tile(np.arange(1, k + 1), len(rows)),
                    np.full(len(white), part.centre.n), pa.array([v for v in part.centre.deviation(x) for _ in range(k)], pa.int64()),
                    pa.array(white, from_pandas=True), pa.array(np.tile(explained, len(rows)), from_pandas=True),
                    pa.array([part.identity_error] * len(white), pa.float64()),
                )
    return whole_vectors(embeddings).mapInArrow(run, WHITE_DDL)
