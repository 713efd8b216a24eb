"""Connected components of a link table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.session import cut, scratch_path


def compact(df: DataFrame) -> DataFrame:
    """``cut`` with stronger compression, for tables of texts and hashes."""
    path = scratch_path(df.sparkSession, "compact")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node reachable by links.

    Alternating large-star and small-star rounds; every round replaces a link by links to the smallest neighbour, so
    the table never grows. A hub's links are only aggregated with partial sums and joined (skewed joins are split), never
    gathered. Rows with a null end or equal ends are ignored; an empty table gives an empty result.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), )
    links = cut(links.where("a > b").distinct())
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
        if now == state or not now[0]:
            break
        state = now
        links = cut(_small_star(_large_star(links)))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node itself)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    # links has a > b, so for the centre b its larger neighbours are the a of its rows
    centre = least.select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    return links.join(centre, "b").select("a", F.col("m").alias("b")).where("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """All smaller neighbours of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
