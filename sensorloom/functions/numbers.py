"""Numeric helpers for readings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

INFINITIES = (float("inf"), float("-inf"))


def round_reading(value: Column, places: int = 2) -> Column:
    """Round half up on the decimal text of the number (2.675 -> 2.68)."""
    return F.round(value, places)


def is_missing(value: Column) -> Column:
    """True for null and NaN, and never null itself."""
    return value.isNull() | F.coalesce(F.isnan(value), F.lit(False))


def finite(value: Column) -> Column:
    """The value where it is a finite number, else null."""
    return F.when(~is_missing(value) & ~value.isin(*INFINITIES), value)


def any_of(conditions: Iterable[Column]) -> Column:
    combined = F.lit(False)
    for condition in conditions:
        combined = combined | condition
    return combined


def all_of(conditions: Iterable[Column]) -> Column:
    combined = F.lit(True)
    for condition in conditions:
        combined = combined & condition
    return combined


def hash_percent(key: Column) -> Column:
    """A stable number from 0 to 99 per key, the same for every layout of the data."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % 100
