"""Points in space: a balanced tree of small leaves, and exact searches across them.

Distances are only ever computed inside a leaf or between one leaf and a bounded chunk
of query points, so a crowded region costs more leaves, not a bigger task. Leaves are split until
they are small, on whatever dimension is widest there; identical points are one weighted
point, hence a split always makes progress.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.ordering import running_total
from demandloom.session import cut

LEAF_POINTS = 2048
QUERY_CHUNK = 4096
BLOCK_POINTS = 128  # compared at once: their matrix stays in the cache
SPLITS = 7
BROADCAST_ROWS = 200_000
# Relative slack for box tests, far above rounding and far below any real gap.
SLACK = 1e-9


def small_side(materialised: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a side that is already materialised and counted as small."""
    return F.broadcast(materialised) if materialised.count() <= rows else materialised


def distinct_points(scaled: DataFrame, features: Sequence[str], key: str = "pdv") -> tuple[DataFrame, DataFrame]:
    """(points, members): each distinct position once, numbered in coordinate order.

    The number depends on the data alone, not on partitioning, and breaks all later ties.
    """
    source = cut(scaled.select(key, *features))
    grouped = source.groupBy(*features).agg(F.count("*").alias("weight"), F.min(key).alias("first_key")).withColumn(
        "one", F.lit(1).cast("long")
    )
    points = cut(
        running_total(grouped, [], features, "one", "id")
        .select("id", F.array(*features).alias("x"), "weight", "first_key", *features)
    )
    members = source.join(points.select("id", *features), list(features)).select(key, "id")
    return points.drop(*features), members


def split_leaves(points: DataFrame, dims: int, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Add ``leaf``: the path of an eight-way tree as text, one digit per level.

    A round costs one aggregation with small quantile sketches. The tree is done after
    log8(points / leaf_points) rounds unless many points share coordinates.
    """
    out = points.withColumn("leaf", F.lit(""))
    cuts = [(i + 1) / (SPLITS + 1) for i in range(SPLITS)]
    while True:
        per_dim = [
            F.struct(
                (F.max(F.col("x")[d]) - F.min(F.col("x")[d])).alias("width"), F.lit(d).alias("dim"),
                F.max(F.col("x")[d]).alias("top"), F.percentile_approx(F.col("x")[d], cuts, 1000).alias("at"),
            )
            for d in range(dims)
        ]
        big = cut(
            out.groupBy("leaf").agg(F.count("*").alias("size"), F.array_max(F.array(*per_dim)).alias("split"))
            .where(F.col("size") > leaf_points).select("leaf", "split")
        )
        if big.isEmpty():
            return out
        value = F.get(F.col("x"), F.col("split.dim"))
        # The top value is always parted from the lowest one, so no split is empty.
        branch = F.size(F.filter("split.at", lambda q: q < value)) + F.when(value == F.col("split.top"), 1).otherwise(0)
        out = cut(
            out.join(small_side(big), "leaf", "left")
            .withColumn("leaf", F.when(F.col("split").isNull(), F.col("leaf")).otherwise(
                F.concat("leaf", branch.cast("string"))))
            .drop("split")
        )


def box_columns(dims: int) -> list[Column]:
    return [
        F.array(*[F.min(F.col("x")[d]) for d in range(dims)]).alias("low"),
        F.array(*[F.max(F.col("x")[d]) for d in range(dims)]).alias("high"),
    ]


def _outer_box(dims: int) -> list[Column]:
    return [
        F.array(*[F.min(F.col("low")[d]) for d in range(dims)]).alias("low"),
        F.array(*[F.max(F.col("high")[d]) for d in range(dims)]).alias("high"),
    ]


def _squared(gaps: list[Column]) -> Column:
    total = gaps[0] * gaps[0]
    for g in gaps[1:]:
        total = total + g * g
    return total


def point_gap(x: Column, low: Column, high: Column, dims: int) -> Column:
    """Squared distance from a point to a box."""
    return _squared([F.greatest(low[d] - x[d], x[d] - high[d], F.lit(0.0)) for d in range(dims)])


def box_gap(low: Column, high: Column, other_low: Column, other_high: Column, dims: int) -> Column:
    return _squared([F.greatest(other_low[d] - high[d], low[d] - other_high[d], F.lit(0.0)) for d in range(dims)])


def diagonal(low: Column, high: Column, dims: int) -> Column:
    return F.sqrt(_squared([high[d] - low[d] for d in range(dims)]))


def within(gap: Column, radius: Column) -> Column:
    return gap <= radius * radius * (1 + SLACK)


def tree_depth(points: DataFrame) -> int:
    return points.agg(F.max(F.length("leaf"))).first()[0] or 0


def tree_levels(leaves: DataFrame, depth: int, dims: int, extra: Sequence[Column] = ()) -> list[DataFrame]:
    """Tree nodes per depth (``node``, ``parent``, box and ``extra`` aggregates over leaves)."""
    return [
        leaves.groupBy(F.substring("leaf", 1, t).alias("node")).agg(*_outer_box(dims), *extra)
        .withColumn("parent", F.substring("node", 1, max(t - 1, 0)))
        for t in range(depth + 1)
    ]


def near_leaves(leaves: DataFrame, levels: list[DataFrame], dims: int, radius: str,
                also: Callable[[], Column] | None = None) -> DataFrame:
    """Pairs (leaf, target) of different leaves whose boxes are within the leaf's radius.

    Descends the tree level by level with an equi-join on the parent node, dropping
    branches that are out of reach. ``also`` is a further test between the columns of the
    searching leaf (``a``) and of the node (``b``).
    """
    frontier = leaves.withColumn("at", F.lit(""))
    for t in range(1, len(levels)):
        a, b = frontier.alias("a"), levels[t].alias("b")
        reach = within(box_gap(F.col("a.low"), F.col("a.high"), F.col("b.low"), F.col("b.high"), dims), F.col(f"a.{radius}"))
        if also is not None:
            reach = reach & also()
        frontier = (
            a.join(b, F.col("a.at") == F.col("b.parent")).where(reach)
            .select(*[F.col(f"a.{c}").alias(c) for c in leaves.columns], F.col("b.node").alias("at"))
        )
    return frontier.where(F.col("at") != F.col("leaf")).select("leaf", F.col("at").alias("target"))


def visit(queries: DataFrame, points: DataFrame, compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
          schema: str, chunk: int = QUERY_CHUNK) -> DataFrame:
    """Run ``compare(queries, points)`` for every target leaf.

    Queries to a leaf are dealt into chunks of about ``chunk`` rows and the leaf's points
    are copied to each, so a leaf that many points ask for is worked on by many tasks.
    ``queries`` should be materialised; they are read twice.
    """
    counts = queries.groupBy("target").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    dealt = queries.join(counts, "target").withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    ).drop("chunks")
    copies = (
        points.withColumnRenamed("leaf", "target").join(counts, "target")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    )
    return dealt.groupBy("target", "chunk").cogroup(copies.groupBy("target", "chunk")).applyInPandas(
        lambda q, p: compare(q, p), schema
    )


def matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["x"].tolist(), dtype=float).reshape(len(frame), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed in dimension order so that every caller gets equal bits."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        gap = a[:, d][:, None] - b[:, d][None, :]
        gap *= gap
        total += gap
    return np.sqrt(total, out=total)


def compact(x: np.ndarray, size: int = BLOCK_POINTS) -> list[np.ndarray]:
    """Rows of ``x`` as blocks of at most ``size`` neighbours, halved on whatever dimension is widest."""
    parts, out = [np.arange(len(x))] if len(x) else [], []
    while parts:
        part = parts.pop()
        if len(part) <= size:
            out.append(part)
            continue
        own, half = x[part], len(part) // 2
        order = np.argpartition(own[:, int(np.argmax(own.max(0) - own.min(0)))], half)
        parts += [part[order[half:]], part[order[:half]]]
    return out


def boxes(x: np.ndarray, blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Low and high corners of blocks of rows."""
    shape = (len(blocks), x.shape[1])
    return np.array([x[b].min(0) for b in blocks]).reshape(shape), np.array([x[b].max(0) for b in blocks]).reshape(shape)


def box_distances(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Distances of one box to many."""
    return np.sqrt((np.maximum(np.maximum(lows - high, low - highs), 0.0) ** 2).sum(1))
