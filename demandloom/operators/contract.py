"""Connected components of a link table by contraction.

In a round every node moves to the least of its neighbours and itself, by the order of a hash, so chains of names in any order stay
short; one more step follows these moves. Links are renamed and those inside a node vanish. Only nodes that still have links take
part in the next round, and the moves are composed for all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.session import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by one of its nodes, the same for all."""
    def ranked(c: str):
        return F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("name"))

    ends = links.select(ranked("a").alias("a"), ranked("b").alias("b")).where("a <> b")
    ends = cut(ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    found = None
    while not ends.isEmpty():
        moves = cut(ends.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")))
        onward = moves.select(F.col("a").alias("to"), F.col("to").alias("next"))
        moves = cut(moves.join(onward, "to").select("a", F.col("next").alias("to")))
        if found is None:
            found = moves
        else:
            later = moves.select(F.col("a").alias("to"), F.col("to").alias("next"))
            found = cut(found.join(later, "to", "left").select("a", F.coalesce("next", "to").alias("to")))
        named = ends.join(moves, "a").select(F.col("to").alias("x"), F.col("b").alias("a")).join(moves, "a").select("x", F.col("to").alias("y"))
        ends = cut(named.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return found.select(F.col("a.name").alias("node"), F.col("to.name").alias("component"))
