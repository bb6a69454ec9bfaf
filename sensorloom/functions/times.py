"""Timestamps as ISO-8601 text with second precision, and as nanoseconds since the epoch."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from sensorloom.schemas import ISO_SECONDS


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def from_iso(text: Column) -> Column:
    """Null where the text is not a timestamp. Fractions and other zones than ``Z`` are understood."""
    return text.try_cast("timestamp")


def epoch_nanos(ts: Column, dtype: T.DataType) -> Column:
    """Nanoseconds since the epoch of a timestamp column, or of ISO text.

    A ``timestamp_ntz`` is taken as UTC whatever the session's time zone is.
    """
    if isinstance(dtype, T.StringType):
        ts = from_iso(ts)
    elif isinstance(dtype, T.TimestampNTZType):
        seconds = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("decimal(20,6)")
        return (seconds * F.lit(1_000_000_000)).cast("bigint")
    return F.unix_micros(ts) * F.lit(1000)
