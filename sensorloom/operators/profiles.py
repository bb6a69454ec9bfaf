"""What is normal: per-sensor baselines, daily profiles, and residuals from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.ordering import BROADCAST_BYTES, ROWS_PER_TASK, busy_keys, fits_broadcast, split_busy, spread_join
from sensorloom.schemas import FEATURES
from sensorloom.session import written


def _moments(values: Sequence[str]):
    for value in values:
        yield F.avg(value).alias(f"{value}_mean")
        yield F.stddev_samp(value).alias(f"{value}_std")


def feature_stats(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean and sample standard deviation of every feature, in one row."""
    return df.agg(*_moments(features))


def baseline(df: DataFrame, key: str = "sensor_id", values: Sequence[str] = FEATURES) -> DataFrame:
    """Mean, spread and number of readings per sensor."""
    return df.groupBy(key).agg(*_moments(values), F.count("*").alias("readings"))


def daily_profile(
    df: DataFrame, key: str = "sensor_id", ts: str = "ts", values: Sequence[str] = FEATURES
) -> DataFrame:
    """The same per sensor and hour of the day."""
    return df.groupBy(key, F.hour(ts).alias("hour")).agg(*_moments(values), F.count("*").alias("readings"))


def residual(
    df: DataFrame,
    profile: DataFrame,
    key: str = "sensor_id",
    ts: str = "ts",
    values: Sequence[str] = FEATURES,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each reading's distance from its sensor's profile for that hour, as ``<value>_residual``.

    ``profile`` should be a stored table, as its size is checked first. Within ``broadcast_bytes`` it is
    broadcast. If it is larger, busy sensors' readings are spread over copies of these sensors' entries, at
    most 24 for each, so that no busy sensor is shuffled to one task; the other sensors' readings are
    joined by shuffle. A null sensor is matched like any other, and a reading without an entry has null
    residuals.
    """
    means = profile.select(
        F.col(key).alias("_key"), F.col("hour").alias("_hour"), *[f"{v}_mean" for v in values]
    )
    same_entry = F.col(key).eqNullSafe(F.col("_key")) & F.col("hour").eqNullSafe(F.col("_hour"))
    timed = df.withColumn("hour", F.hour(ts))

    def distances(joined: DataFrame) -> DataFrame:
        gaps = [(F.col(v) - F.col(f"{v}_mean")).alias(f"{v}_residual") for v in values]
        return joined.select(*df.columns, "hour", *gaps)

    if fits_broadcast(means, broadcast_bytes):
        return distances(timed.join(F.broadcast(means), same_entry, "left"))

    keys = busy_keys(timed, key, rows_per_task)
    busy_rows, other_rows = split_busy(timed, key, keys, broadcast_bytes)
    entries = written(spread_join(means, keys, F.col("_key").eqNullSafe(F.col("_busy")), "left_semi", ["_hour"], broadcast_bytes), "entries")
    busy = spread_join(busy_rows, entries, same_entry, "left", df.columns, broadcast_bytes)
    return distances(busy).unionByName(distances(other_rows.join(means, same_entry, "left")))
