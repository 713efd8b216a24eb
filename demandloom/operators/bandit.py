"""Product propensity: a Beta-Bernoulli arm per (store category, product) over 52 weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import week_of
from demandloom.functions.random import keyed_beta
from demandloom.schema import CATEGORY, PRODUCT, STORE, WEEKS
from demandloom.session import cut

# Store keys up to this many rows (tens of MB) are sent to every executor.
BROADCAST_ROWS = 500_000


def week_mask(week: Column) -> Column:
    """One bit per calendar week; weeks outside 1..52 set none."""
    return F.when(week.between(1, WEEKS), F.call_function("shiftleft", F.lit(1).cast("long"), week)).otherwise(
        F.lit(0).cast("long")
    )


def arm_weeks(sales: DataFrame, stores: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Weeks in which each (category, product) sold, as a bit mask; from sales or ``sale_lines``.

    The mask makes "distinct weeks" a plain OR, which combines on the map side. While the
    counted store table is small it is broadcast and raw sales are never shuffled. Beyond
    that, masks are first built per (store, product), which spreads hot stores, and only
    those meet the stores.
    """
    categories = stores.select(F.col("pdv").alias(STORE), CATEGORY)
    week = week_of(F.col("transaction_date")) if "transaction_date" in sales.columns else F.col("week")
    lines = sales.select(STORE, PRODUCT, week_mask(week).alias("mask"))
    if categories.limit(broadcast_rows + 1).count() <= broadcast_rows:
        joined = lines.join(F.broadcast(categories), STORE)
    else:
        joined = lines.groupBy(STORE, PRODUCT).agg(F.bit_or("mask").alias("mask")).join(categories, STORE)
    return joined.groupBy(CATEGORY, PRODUCT).agg(F.bit_or("mask").alias("mask"))


def with_week_counts(arms: DataFrame) -> DataFrame:
    """Number of sold weeks and the last of them, read off the mask."""
    return arms.withColumns({
        "sold_weeks": F.bit_count("mask").cast("int"),
        "last_week": F.when(F.col("mask") > 0, F.length(F.bin("mask")) - 1).otherwise(0).cast("int"),
    })


def arm_table(arms: DataFrame) -> DataFrame:
    """Prior state: one row per arm."""
    return arms.select(
        CATEGORY, PRODUCT, F.lit(1).alias("alpha"), F.lit(1).alias("beta"), F.lit(0.0).alias("probability")
    )


def posterior(arms: DataFrame) -> DataFrame:
    """State after week 52: every sold week adds 1 to alpha, every other to beta."""
    return with_week_counts(arms).select(
        CATEGORY, PRODUCT,
        (1 + F.col("sold_weeks")).alias("alpha"),
        (1 + WEEKS - F.col("sold_weeks")).alias("beta"),
    )


def last_draw_parameters(arms: DataFrame) -> DataFrame:
    """State at the last sold week, the one whose draw survives; null if never sold."""
    sold = F.col("sold_weeks") > 0
    return with_week_counts(arms).select(
        CATEGORY, PRODUCT,
        F.when(sold, 1 + F.col("sold_weeks")).alias("alpha"),
        F.when(sold, 1 + F.col("last_week") - F.col("sold_weeks")).alias("beta"),
    )


def draw(arms: DataFrame, seed: int = 42) -> DataFrame:
    """One seeded Beta draw per arm; never sold means probability 0."""
    # the category's length keeps names with a "|" apart
    key = F.concat(F.length(CATEGORY).cast("string"), F.lit(":"), CATEGORY, F.lit("|"), PRODUCT)
    sampled = keyed_beta(F.col("alpha"), F.col("beta"), seed, key)
    return last_draw_parameters(arms).select(
        CATEGORY, PRODUCT, F.when(F.col("alpha").isNull(), 0.0).otherwise(sampled).alias("probability")
    )


def trajectory(arms: DataFrame) -> DataFrame:
    """State of every arm after every week.

    The running count is the number of bits up to the week, so no window is needed.
    """
    upto = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("week") + 1) - 1
    sold = F.bit_count(F.col("mask").bitwiseAND(upto)).cast("int")
    return (
        arms.select(CATEGORY, PRODUCT, "mask", F.explode(F.sequence(F.lit(1), F.lit(WEEKS))).alias("week"))
        .select(CATEGORY, PRODUCT, "week", (1 + sold).alias("alpha"), (1 + F.col("week") - sold).alias("beta"))
    )


def category_shares(drawn: DataFrame) -> DataFrame:
    """Probability as share of its category; null where a category sums to 0.

    Totals are aggregated and joined back. A window per category would pull all products
    of a category into one task. The draws are materialised, because both sides need them.
    """
    drawn = cut(drawn)
    totals = drawn.groupBy(CATEGORY).agg(F.sum("probability").alias("total"))
    return drawn.join(totals, CATEGORY).select(
        CATEGORY, PRODUCT, "probability", F.try_divide("probability", "total").alias("share")
    )


def category_lists(shares: DataFrame) -> DataFrame:
    """Array form: products of a category with probabilities and shares, in product order.

    For output only; a list is as long as the assortment of its category.
    """
    items = F.array_sort(F.collect_list(F.struct(PRODUCT, "probability", "share")))
    return shares.groupBy(CATEGORY).agg(items.alias("items")).select(
        CATEGORY,
        F.col(f"items.{PRODUCT}").alias(PRODUCT),
        F.col("items.probability").alias("probability"),
        F.col("items.share").alias("scaled_prob"),
    )


def store_product_shares(shares: DataFrame, stores: DataFrame, min_share: float = 0.0) -> DataFrame:
    """Shares of a store's category as rows (store, product, share).

    One row per store and product of its category: meant for few products or a
    ``min_share``. The forecast plan uses ``allocate``, which never builds this table.
    """
    kept = shares.where(F.col("share") > min_share) if min_share else shares
    return stores.select("pdv", CATEGORY).join(kept.select(CATEGORY, PRODUCT, "share"), CATEGORY)
