"""Scalar rules on store and sales columns, and selection of columns by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The one code whose leading zero was lost, and the on-premise label.
ZIP_REPAIRS = {"8107": "08107"}
ON_PREMISE = "On Premise"


def week_of(date: Column) -> Column:
    """ISO week number 1..53; years fold together."""
    return F.weekofyear(date)


def repair_zip(zipcode: Column, repairs: Mapping[str, str] = ZIP_REPAIRS, width: int | None = None) -> Column:
    """Zip code as text, with known broken codes replaced or all padded to ``width``."""
    text = zipcode.cast("string")
    if width is not None:
        return F.lpad(text, width, "0")
    fixed = text
    for broken, right in repairs.items():
        fixed = F.when(text == broken, F.lit(right)).otherwise(fixed)
    return fixed


def is_on_premise(premise: Column) -> Column:
    """1 for exactly ``On Premise``, else 0."""
    return F.when(premise == ON_PREMISE, 1).otherwise(0)


def premise_contains_on(premise: Column) -> Column:
    """1 where the text contains ``On`` anywhere, else 0."""
    return F.when(premise.contains("On"), 1).otherwise(0)


def horizontal_sum(columns: Iterable[Column]) -> Column:
    """Row-wise sum that skips nulls."""
    return reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0.0)) for c in columns))


def floor_int(value: Column) -> Column:
    """Whole part as an integer; what exceeds the largest integer becomes it, instead of failing the whole plan."""
    return F.floor(F.when(value > 2147483647.0, F.lit(2147483647.0)).otherwise(value)).cast("int")


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Columns in table order that start with a prefix; a prefix without match is an error."""
    missing = [p for p in prefixes if not any(c.startswith(p) for c in df.columns)]
    if missing:
        raise ValueError(f"no column starts with {missing}")
    return [c for c in df.columns if c.startswith(prefixes)]


def columns_with_suffix(df: DataFrame, *suffixes: str, outside_prefix: str | None = None) -> list[str]:
    """Columns that end with a suffix, optionally only those without the given prefix."""
    return [
        c for c in df.columns
        if c.endswith(suffixes) and not (outside_prefix and c.startswith(outside_prefix))
    ]


def scale_array(values: Column, factor: Column) -> Column:
    """Every element times one number."""
    return F.transform(values, lambda v: v * factor)


def normalise_array(values: Column) -> Column:
    """Elements as shares of their sum; null when the sum is zero."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(values, lambda v: F.try_divide(v, total))
