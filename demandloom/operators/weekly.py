"""Weekly sales facts per store or store category, and the dense 52-week calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import is_on_premise, week_of
from demandloom.schema import CATEGORY, MEASURES, PRODUCT, STORE, WEEKED_STATICS, WEEKS, WINDOWED


def most_frequent(rows: str, value: str, when: Column | None = None) -> Column:
    """Value with the largest ``rows``; the smallest value wins ties.

    Needs one row per value. The buffer is one struct, so it combines on the map side
    whatever the number of values.
    """
    pair = F.struct((-F.col(rows)).alias("n"), F.col(value).alias("v"))
    return F.min(pair if when is None else F.when(when, pair)).getField("v")


def product_weeks(sales: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sums and row counts per (store, week, product).

    Everything weekly is built on this level: a store, or one of its weeks, that owns a
    large part of all rows is spread over its products before the next shuffle.
    """
    return sales.groupBy(STORE, week_of(F.col("transaction_date")).alias("week"), PRODUCT).agg(
        F.count("*").alias("rows"),
        *[F.count(m).alias(f"n_{m}") for m in measures],
        *[F.sum(m).alias(m) for m in measures],
    )


def sale_lines(sales: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Row counts and sums per (store, week, product, distributor): what profiles, windows and arms of a complete run can
    all be made of, so that raw sales are read once."""
    return sales.groupBy(STORE, week_of(F.col("transaction_date")).alias("week"), PRODUCT, "distributor_id").agg(
        F.count("*").alias("rows"),
        *[F.count(m).alias(f"n_{m}") for m in measures],
        *[F.sum(m).alias(m) for m in measures],
    )


def store_weeks_of_lines(lines: DataFrame, measures: Sequence[str], products: bool) -> DataFrame:
    """``store_weeks`` from ``sale_lines``."""
    sums = [F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures]
    if not products:
        return lines.groupBy(STORE, "week").agg(*sums)
    level = lines.groupBy(STORE, "week", PRODUCT).agg(F.sum("rows").alias("rows"), *[F.sum(m).alias(m) for m in measures])
    return level.groupBy(STORE, "week").agg(
        F.sum("rows").alias("product_rows"), F.count("*").alias("product_diversity"),
        most_frequent("rows", PRODUCT).alias("most_bought_product"), *sums,
    )


def store_weeks(sales: DataFrame, measures: Sequence[str] = MEASURES, products: bool = True, gathered: bool = False) -> DataFrame:
    """Sales per (store, week): measure sums and, with ``products``, counts and top product.

    Without the product columns the sums combine on the map side and shuffle once. With ``gathered``, product rows go to their store at
    once, and what is grouped or joined by store afterwards shuffles no more; a store has one a week and product at most.
    """
    sums = [F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures]
    if not products:
        return sales.groupBy(STORE, week_of(F.col("transaction_date")).alias("week")).agg(*sums)
    level = product_weeks(sales, measures)
    return (level.repartition(STORE) if gathered else level).groupBy(STORE, "week").agg(
        F.sum("rows").alias("product_rows"),
        F.count("*").alias("product_diversity"),
        most_frequent("rows", PRODUCT).alias("most_bought_product"),
        *sums,
    )


def category_weeks(sales: DataFrame, stores: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sales per (category, week): mean measure per sale, product counts, modes.

    The store join runs on pre-aggregated rows. Product and cluster totals come from one
    grouping-sets pass, so that a category is never gathered in one task.
    """
    has_cluster = "cluster" in stores.columns
    attributes = stores.select(
        F.col("pdv").alias(STORE), CATEGORY, is_on_premise(F.col("premise")).alias("on_premise"),
        (F.col("cluster") if has_cluster else F.lit(None).cast("int")).alias("cluster"),
    )
    by_product = [F.col(CATEGORY), F.col("week"), F.col(PRODUCT)]
    by_cluster = [F.col(CATEGORY), F.col("week"), F.col("cluster")]
    levels = [by_product, by_cluster] if has_cluster else [by_product]
    totals = (
        product_weeks(sales, measures).join(attributes, STORE)
        .groupingSets(levels, CATEGORY, "week", PRODUCT, "cluster")
        .agg(
            F.grouping(PRODUCT).alias("by_cluster"),
            F.sum("rows").alias("rows"),
            F.sum(F.col("on_premise") * F.col("rows")).alias("on_rows"),
            *[F.sum(f"n_{m}").alias(f"n_{m}") for m in measures],
            *[F.sum(m).alias(m) for m in measures],
        )
    )
    products = F.col("by_cluster") == 0
    facts = totals.groupBy(CATEGORY, "week").agg(
        F.sum(F.when(products, F.col("rows"))).alias("product_rows"),
        F.count_if(products).alias("product_diversity"),
        most_frequent("rows", PRODUCT, products).alias("most_bought_product"),
        most_frequent("rows", "cluster", ~products).alias("cluster"),
        F.when(F.sum("on_rows") * 2 > F.sum("rows"), 1).otherwise(0).alias("premise"),
        *[
            F.try_divide(F.sum(F.when(products, F.col(m))), F.sum(F.when(products, F.col(f"n_{m}")))).alias(m)
            for m in measures
        ],
    )
    return facts if has_cluster else facts.drop("cluster")


def store_attributes(stores: DataFrame) -> DataFrame:
    """Static store columns used as model features, one row per store."""
    return stores.select(
        F.col("pdv").alias(STORE),
        *[F.col(c) for c in ("cluster",) if c in stores.columns],
        is_on_premise(F.col("premise")).alias("premise"),
    )


def weekly_facts(sales: DataFrame, stores: DataFrame, key: str = STORE) -> DataFrame:
    """Weekly preparation in one call, by store (sums) or by store category (means)."""
    if key == STORE:
        return store_weeks(sales, gathered=True).join(store_attributes(stores), STORE)
    if key == CATEGORY:
        return category_weeks(sales, stores)
    raise ValueError(f"key must be {STORE} or {CATEGORY}, not {key}")


def usual_product(facts: DataFrame, key: str = STORE) -> DataFrame:
    """The product that is most often the most bought one of a week."""
    return (
        facts.groupBy(key, "most_bought_product").agg(F.count("*").alias("rows"))
        .groupBy(key).agg(most_frequent("rows", "most_bought_product").alias("most_bought_product"))
    )


def category_product_week_mean(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Mean over stores of a store's weekly quantity, per (category, product, week)."""
    return (
        sales.groupBy(STORE, week_of(F.col("transaction_date")).alias("week"), PRODUCT)
        .agg(F.sum("quantity").alias("quantity"))
        .join(stores.select(F.col("pdv").alias(STORE), CATEGORY), STORE)
        .groupBy(CATEGORY, PRODUCT, "week")
        .agg(F.avg("quantity").alias("quantity"))
    )


def weekly_arrays(facts: DataFrame, key: str = STORE, columns: Sequence[str] = WINDOWED) -> DataFrame:
    """One row per key with ``weeks``: 52 structs in week order, zero where nothing sold and for measures that are null.

    A key has at most 53 weekly facts, so the collected group is bounded, and one shuffle
    on the key replaces a calendar product, a join and a window. Keys whose only sales
    fall in week 53 stay, with 52 empty weeks.
    """
    columns = [*columns, *[c for c in WEEKED_STATICS if c in facts.columns and c not in columns]]
    inside = F.col("week").between(1, WEEKS)
    values = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    empty = F.struct(*[F.lit(0.0).alias(c) for c in columns])
    sold = F.map_from_entries(F.collect_list(F.when(inside, F.struct(F.col("week"), values))))
    return facts.groupBy(key).agg(sold.alias("sold")).select(
        key,
        F.transform(
            F.sequence(F.lit(1), F.lit(WEEKS)),
            lambda w: F.coalesce(F.try_element_at(F.col("sold"), w), empty),
        ).alias("weeks"),
    )


def dense_calendar(facts: DataFrame, key: str = STORE, columns: Sequence[str] = WINDOWED) -> DataFrame:
    """Long form of the calendar: one row per (key, week 1..52)."""
    return (
        weekly_arrays(facts, key, columns)
        .select(key, F.posexplode("weeks").alias("pos", "values"))
        .select(key, (F.col("pos") + 1).alias("week"), *[F.col(f"values.{c}") for c in columns])
    )


def sorted_facts(facts: DataFrame, key: str = STORE) -> DataFrame:
    """Facts in (key, week) order, for a sink."""
    return facts.orderBy(key, "week")
