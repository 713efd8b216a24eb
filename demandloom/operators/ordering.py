"""Running totals and neighbours in a total order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.session import cut


def order_runs(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Range-partition by (group, order) and remember each row's partition as ``run``.

    ``order`` must be unique inside a group. The result is materialised, because the
    range bounds are sampled and must not change between the steps that follow.
    """
    keys = [*group, *order]
    return cut(df.repartitionByRange(*keys).withColumn("run", F.spark_partition_id()))


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, total: str,
                  following: dict[str, str] | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in each group, as column ``total``.

    Windows stay inside one range partition; what came before is added from a table with
    one row per (group, partition). ``following`` maps new column names to columns whose
    value is taken from the next row of the group (null on the last).
    """
    following = following or {}
    runs = order_runs(df, group, order)
    inside = Window.partitionBy(*group, "run").orderBy(*order)
    first = F.struct(*order, *[F.col(c).alias(f"next_{n}") for n, c in following.items()])
    per_run = runs.groupBy(*group, "run").agg(F.sum(value).alias("run_total"), F.min(first).alias("first"))
    across = Window.partitionBy(*group).orderBy("run")
    offsets = per_run.select(
        *group, "run",
        (F.sum("run_total").over(across) - F.col("run_total")).alias("before"),
        F.lead("first").over(across).alias("next_first"),
    )
    out = runs.withColumn(total, F.sum(value).over(inside))
    for name, column in following.items():
        out = out.withColumn(f"lead_{name}", F.lead(column).over(inside))
        out = out.withColumn(f"end_{name}", F.lead(F.lit(1)).over(inside).isNull())
    out = out.join(offsets, [*group, "run"])
    out = out.withColumn(total, F.col(total) + F.col("before"))
    for name in following:
        out = out.withColumn(
            name,
            F.when(F.col(f"end_{name}"), F.col(f"next_first.next_{name}")).otherwise(F.col(f"lead_{name}")),
        ).drop(f"lead_{name}", f"end_{name}")
    return out.drop("run", "before", "next_first")
