"""Sliding lag/target windows over the dense calendar, and the frames cut from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import columns_with_prefix
from demandloom.operators.weekly import store_weeks, store_weeks_of_lines, weekly_arrays
from demandloom.schema import HORIZON, LAGS, MEASURES, STORE, WEEKS, WINDOWED, numbered

# Default model features. "cluster" and "premise" are whole columns, the rest lag blocks.
FEATURES = ("quantity", "cluster", "net_value", "gross_profit", "premise")
ATTRIBUTES = ("cluster", "premise")


def window_ends(length: int, last_weeks: Sequence[int] | None = None) -> Sequence[int]:
    """Last weeks of all full windows, or the asked ones after a check."""
    ends = range(length, WEEKS + 1) if last_weeks is None else last_weeks
    bad = [w for w in ends if not length <= w <= WEEKS]
    if bad:
        raise ValueError(f"no full window of {length} weeks ends at {bad}")
    return ends


def sliding_windows(
    arrays: DataFrame,
    key: str = STORE,
    length: int = LAGS + HORIZON,
    measures: Sequence[str] = WINDOWED,
    last_weeks: Sequence[int] | None = None,
) -> DataFrame:
    """Full windows as arrays, labelled by their last week.

    Only the requested windows are generated; none of them needs another shuffle.
    """
    ends = window_ends(length, last_weeks)
    others = [c for c in arrays.columns if c not in (key, "weeks")]
    return (
        arrays.select(key, *others, "weeks", F.explode(F.array(*[F.lit(w) for w in ends])).alias("week"))
        .select(key, "week", *others, F.slice("weeks", F.col("week") - (length - 1), length).alias("window"))
        .select(key, "week", *others, *[F.col(f"window.{m}").alias(m) for m in measures])
    )


def window_features(
    arrays: DataFrame,
    key: str = STORE,
    lags: int = LAGS,
    horizon: int = HORIZON,
    measures: Sequence[str] = WINDOWED,
    last_weeks: Sequence[int] | None = None,
    attributes_at_start: bool = False,
) -> DataFrame:
    """Windows as numbered columns ``quantity01 .. quantity13``, seven measures wide.

    With ``attributes_at_start`` the store attributes are read from the first week of the
    window, where a week without sales counts as 0; otherwise the caller joins them.
    """
    length = lags + horizon
    ends = window_ends(length, last_weeks)
    week_fields = arrays.schema["weeks"].dataType.elementType.fieldNames()
    firsts = [c for c in ATTRIBUTES if attributes_at_start and c in week_fields]
    others = [c for c in arrays.columns if c not in (key, "weeks", *firsts)]
    first = F.col("week") - (length - 1)

    def value(at, name: str):  # of the one struct, not of a copied series
        return F.element_at("weeks", at).getField(name)

    return (
        arrays.select(key, *others, "weeks", F.explode(F.array(*[F.lit(w) for w in ends])).alias("week"))
        .select(
            key, "week", *others,
            *[value(first, c).alias(c) for c in firsts],
            *[value(first + (k - 1), m).alias(numbered(m, k)) for m in measures for k in range(1, length + 1)],
        )
    )


def windowed_measures(features: Sequence[str] = FEATURES) -> list[str]:
    """The measures whose windows a feature list needs."""
    return [m for m in WINDOWED if m in features]


def store_windows(sales: DataFrame, attributes: DataFrame, measures: Sequence[str] = WINDOWED, **options) -> DataFrame:
    """Window features from sales or ``sale_lines``, with the static attributes joined once per store.

    Only the asked measures are aggregated; product counts are formed only if asked.
    """
    sums = [m for m in measures if m in MEASURES]
    build = store_weeks if "transaction_date" in sales.columns else store_weeks_of_lines
    facts = build(sales, sums, products=len(sums) < len(measures))
    arrays = weekly_arrays(facts, STORE, measures).join(attributes, STORE)
    return window_features(arrays, measures=measures, **options)


def target_columns(lags: int = LAGS, horizon: int = HORIZON) -> list[str]:
    return [numbered("quantity", k) for k in range(lags + 1, lags + horizon + 1)]


def feature_columns(windows: DataFrame, features: Sequence[str] = FEATURES, lags: int = LAGS) -> list[str]:
    """Feature block chosen by prefix: whole attribute columns and lag columns 01..lags."""
    if "quantity" not in features:
        raise ValueError("past quantities must be among the features")
    beyond = {c for m in WINDOWED for c in (numbered(m, k) for k in range(lags + 1, 100))}
    return [c for c in columns_with_prefix(windows, *features) if c not in beyond]


def training_frame(windows: DataFrame, last_week: int, key: str = STORE, features: Sequence[str] = FEATURES,
                   lags: int = LAGS, horizon: int = HORIZON) -> DataFrame:
    """Features and targets of the windows that end in one week; the key stays in the row."""
    return windows.where(F.col("week") == last_week).select(
        key, *feature_columns(windows, features, lags), *target_columns(lags, horizon)
    )


def train_targets(windows: DataFrame, key: str = STORE, lags: int = LAGS, horizon: int = HORIZON) -> DataFrame:
    return windows.select(key, "week", *target_columns(lags, horizon))


def lag_source(k: int, horizon: int = HORIZON, mode: str = "contiguous") -> int:
    """Window position that becomes lag ``k`` when scoring.

    ``contiguous`` moves the lags to the end of the window. ``compat`` also loses every
    position whose number ends in one of the horizon digits (01-05 and 11-13 for 5), so
    that the last lags keep their old position.
    """
    moved = k + horizon
    if mode == "contiguous":
        return moved
    if mode != "compat":
        raise ValueError(f"mode must be contiguous or compat, not {mode}")
    def lost(n):
        return f"{n:02d}".endswith(tuple(str(i) for i in range(1, horizon + 1)))

    if not lost(moved):
        return moved
    if lost(k):
        raise ValueError(f"lag {k} has no source in compat mode")
    return k


def scoring_frame(windows: DataFrame, last_week: int = WEEKS, key: str = STORE, features: Sequence[str] = FEATURES,
                  lags: int = LAGS, horizon: int = HORIZON, mode: str = "contiguous") -> DataFrame:
    """The features of ``last_week`` shifted so that they predict the weeks after it."""
    names = feature_columns(windows, features, lags)
    lagged = {numbered(m, k): numbered(m, lag_source(k, horizon, mode)) for m in WINDOWED for k in range(1, lags + 1)}
    return windows.where(F.col("week") == last_week).select(
        key, *[F.col(lagged.get(c, c)).alias(c) for c in names]
    )
