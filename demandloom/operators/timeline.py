"""Windows over calendars of any length: ISO weeks numbered without gaps, in rows of one bounded block each.

``week_ordinal`` counts Mondays, so years neither fold together nor leave a gap at week 52 or 53. A key's weeks lie in blocks of 52.
A block also receives the last weeks of the block before it, as many as a window reaches back, so every window lies in one row,
however long the history is, and the longest row does not grow with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.schema import HORIZON, LAGS, STORE, numbered

BLOCK = 52


def week_ordinal(date: Column) -> Column:
    """Weeks since the one that began on Monday 1969-12-29."""
    days = F.unix_date(date) + 3
    return ((days - F.pmod(days, F.lit(7))) / 7).cast("long")


def ordinal_facts(sales: DataFrame, measures: Sequence[str], key: str = STORE) -> DataFrame:
    """Sums per (key, ordinal week)."""
    return sales.groupBy(key, week_ordinal(F.col("transaction_date")).alias("week")).agg(
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures])


def long_windows(facts: DataFrame, measures: Sequence[str], key: str = STORE, length: int = LAGS + HORIZON, first: int | None = None,
                 last: int | None = None) -> DataFrame:
    """All full windows inside the weeks ``first`` .. ``last`` (those of the facts, if not given) of every key of the facts.

    Columns are the key, ``week`` (the window's last one) and numbered measures, 0 where nothing sold. Weeks outside are ignored;
    a calendar shorter than a window gives no rows.
    """
    if not 1 <= length <= BLOCK:
        raise ValueError(f"windows have 1 to {BLOCK} weeks")
    if first is None or last is None:
        known = facts.agg(F.min("week").alias("first"), F.max("week").alias("last")).first()
        first, last = known["first"] if first is None else first, known["last"] if last is None else last
    reach = length - 1
    empty = F.struct(*[F.lit(0.0).alias(m) for m in measures])
    if first is None or last is None or last - first < reach:
        blocks: list[int] = []
    else:
        blocks = list(range((first + reach) // BLOCK, last // BLOCK + 1))
    block = F.floor(F.col("week") / BLOCK)
    place = F.col("week") - block * BLOCK
    homes = F.array(F.struct(block.alias("block"), place.alias("at")), F.struct((block + 1).alias("block"), (place - BLOCK).alias("at")))
    values = F.struct(*[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in measures])
    sold = facts.where(F.col("week").between(F.lit(first), F.lit(last))).select(key, values.alias("values"), F.inline(homes)).where(
        F.col("at") >= -reach)
    every = facts.select(key).distinct().select(
        key, F.lit(None).cast(sold.schema["values"].dataType).alias("values"),
        F.explode(F.array(*[F.lit(b).cast("long") for b in blocks]).cast("array<bigint>")).alias("block"), F.lit(None).cast("long").alias("at"))
    # at most 52 weeks, the reach of a window, and the row that makes the block exist
    rows = sold.select(key, "values", "block", "at").unionByName(every).groupBy(key, "block").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "values")))).alias("sold"), F.max(F.col("at").isNull()).alias("asked"))
    weeks = F.transform(F.sequence(F.lit(-reach).cast("long"), F.lit(BLOCK - 1).cast("long")), lambda p: F.coalesce(F.try_element_at(F.col("sold"), p), empty))
    dense = rows.where("asked").select(key, "block", weeks.alias("weeks"))
    ends = dense.select(key, *[F.col(f"weeks.{m}").alias(f"all_{m}") for m in measures], (F.col("block") * BLOCK).alias("start"),
                        F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))).alias("end")).withColumn("week", F.col("start") + F.col("end"))
    inside = ends.where(F.col("week").between(F.lit((first or 0) + reach), F.lit(last)))
    return inside.select(key, "week", *[
        F.element_at(f"all_{m}", F.col("end") + k).alias(numbered(m, k)) for m in measures for k in range(1, length + 1)])
