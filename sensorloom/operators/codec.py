"""Messages to readings and back, bad-record screening, and the scored projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorloom.functions.lineprotocol import can_be_tag, line_protocol
from sensorloom.functions.numbers import all_of, any_of, finite, is_missing
from sensorloom.functions.times import epoch_nanos, from_iso
from sensorloom.schemas import FEATURES, MEASUREMENT, PREDICTED, READING, SCORED


def encode_json(df: DataFrame, columns: Sequence[str] = tuple(READING.names), keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row as the message ``value``; null columns are left out of the object."""
    return df.select(*keep, F.to_json(F.struct(*columns)).alias("value"))


def decode_json(
    messages: DataFrame, schema: T.StructType = READING, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse each message against ``schema`` and return its fields as columns.

    A message that is not such an object becomes a row of nulls; see :func:`is_valid`.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(*keep, parsed.alias("reading")).select(*keep, "reading.*")


def is_valid(
    required: Sequence[str] = tuple(READING.names),
    numbers: Sequence[str] = FEATURES,
    times: Sequence[str] = ("timestamp",),
    tags: Sequence[str] = ("sensor_id",),
) -> Column:
    """True where no required column is null, no number is NaN, every time is one, and every tag can be stored; never null.

    Malformed JSON parses to a struct of nulls, not to a null struct, so the fields are tested. A time
    that is none would be set by the store, at its arrival; a tag that line protocol cannot carry would
    be refused by it. ``times`` and ``tags`` that are not required are not tested.
    """
    bad = [F.col(c).isNull() for c in required if c not in numbers]
    bad += [is_missing(F.col(c)) for c in numbers]
    bad += [from_iso(F.col(c)).isNull() for c in times if c in required]
    bad += [F.coalesce(~can_be_tag(F.col(c)), F.lit(False)) for c in tags if c in required]
    return ~any_of(bad)


def split_valid(
    df: DataFrame, required: Sequence[str] = tuple(READING.names), numbers: Sequence[str] = FEATURES
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: together exactly the input."""
    valid = is_valid(required, numbers)
    return df.filter(valid), df.filter(~valid)


def scored_columns(df: DataFrame, prediction: str = "prediction", keep: Sequence[str] = ()) -> DataFrame:
    """The stored form of a scored reading."""
    stored = [c for c in SCORED.names if c != PREDICTED]
    return df.select(*keep, *stored, F.col(prediction).cast("int").alias(PREDICTED))


def to_line_protocol(
    df: DataFrame,
    measurement: str = MEASUREMENT,
    tags: Sequence[str] = ("sensor_id",),
    fields: Sequence[str] = FEATURES,
    ts: str = "timestamp",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One ``line`` per reading; a reading without any finite field, or with a tag that cannot be carried, has none."""
    line = line_protocol(
        F.lit(measurement),
        {c: F.col(c) for c in tags},
        {c: F.col(c) for c in fields},
        epoch_nanos(F.col(ts), df.schema[ts].dataType),
    )
    has_field = any_of(finite(F.col(c)).isNotNull() for c in fields)
    carried = [F.coalesce(can_be_tag(F.col(c)), F.lit(True)) for c in tags]
    return df.filter(has_field & all_of(carried)).select(*keep, line.alias("line"))


def latest_per_point(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """What a time-series store keeps: per point and field the newest value that is a finite number.

    A field that is missing in the newest row is not written, so the store keeps the older one. An
    aggregate, not a window, so that copies of one point are combined before the shuffle.
    """
    newest = [F.max_by(v, F.when(finite(F.col(v)).isNotNull(), F.col(order))).alias(v) for v in values]
    return df.groupBy(*keys).agg(*newest)
