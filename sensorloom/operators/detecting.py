"""Detectors for the two kinds of anomaly a row-at-a-time model cannot see.

A spike is a jump away from the sensor's recent mean in one reading. A stuck sensor repeats one
value over consecutive readings. Both depend on the order of one sensor's readings, and a busy
sensor's history can be too long for one task; see :func:`in_pieces` for how it is cut.

``id`` breaks ties between readings of one time, as a message offset does. Where there is none, give
the time column; equal times of one sensor are then in no particular order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.window import WindowSpec

from sensorloom.functions.numbers import finite, is_missing
from sensorloom.operators.ordering import BROADCAST_BYTES, ROWS_PER_TASK, in_pieces
from sensorloom.schemas import LABEL

# Readings a stuck sensor repeats at least, and the smallest jump of a spike.
STUCK_READINGS = 15
SPIKE_JUMP = 15.0
TRAILING_READINGS = 20


def _is_spike(order: WindowSpec, value: str, n: int, threshold: float) -> Column:
    # NaN and infinity are no readings: they would spoil the mean, and compare as larger than any number.
    reading, trailing = finite(F.col(value)), order.rowsBetween(-n, -1)
    far = F.abs(reading - F.avg(reading).over(trailing)) >= threshold
    return F.coalesce((F.count(reading).over(trailing) == n) & far, F.lit(False))


def is_reading(df: DataFrame, value: str) -> Column:
    """True where a watched value, which can be of any type, is neither null nor NaN."""
    fractional = isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType))
    return ~is_missing(F.col(value)) if fractional else F.col(value).isNotNull()


def _so_far(order: WindowSpec) -> WindowSpec:
    return order.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _starts_run(order: WindowSpec, value: str) -> Column:
    """1 on a piece's first reading and wherever the value is not the previous one's, else 0."""
    first = F.row_number().over(order) == 1
    return (first | ~F.col(value).eqNullSafe(F.lag(value).over(order))).cast("int")


def spikes(
    df: DataFrame,
    key: str = "sensor_id",
    ts: str = "ts",
    id: str = "event_id",
    value: str = "temperature",
    n: int = TRAILING_READINGS,
    threshold: float = SPIKE_JUMP,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Readings at least ``threshold`` away from the mean of the sensor's ``n`` previous ones.

    A reading with fewer than ``n`` finite readings among those is not judged, nor is one that is not finite.
    """
    cut = in_pieces(df, key, [ts, id], before=n, rows_per_task=rows_per_task, broadcast_bytes=broadcast_bytes)
    order = Window.partitionBy(key, "_piece").orderBy(ts, id)
    marked = cut.withColumn("_spike", _is_spike(order, value, n, threshold))
    return marked.filter(F.col("_spike") & F.col("_own")).select(*df.columns)


def partial_runs(
    df: DataFrame, key: str, ts: str, id: str, value: str,
    rows_per_task: int = ROWS_PER_TASK, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Runs of equal values inside each piece; ``edge`` marks those touching a piece's border."""
    needed = df.select(*dict.fromkeys([key, ts, id, value]))
    cut = in_pieces(needed, key, [ts, id], rows_per_task=rows_per_task, broadcast_bytes=broadcast_bytes)
    order = Window.partitionBy(key, "_piece").orderBy(ts, id)
    marked = cut.withColumn("_starts", _starts_run(order, value)).withColumn(
        "_last", F.lead(F.lit(True)).over(order).isNull()
    )
    # The value is one per run; as a grouping column it keeps the aggregate hash-based.
    return (
        marked.withColumn("run", F.sum("_starts").over(_so_far(order)))
        .groupBy(key, "_piece", "run", value)
        .agg(
            F.min(ts).alias("start"),
            F.max(ts).alias("end"),
            F.count("*").alias("readings"),
            F.max("_last").alias("_last"),
        )
        .withColumn("carried", F.lit(0).cast("bigint"))
        .withColumn("edge", (F.col("run") == 1) | F.col("_last"))
        .drop("_last")
    )


def stitched_runs(partials: DataFrame, key: str, value: str) -> DataFrame:
    """Join the runs that continue over a piece's border; ``latest`` marks each key's last run.

    Only edge runs, at most two per piece, are brought together per key. All others stay apart by
    piece, so a busy key is not gathered in one task here either.
    """
    order = Window.partitionBy(key, "_lane").orderBy("_piece", "run")
    continues = (
        F.col("edge")
        & (F.lag("_piece").over(order) != F.col("_piece"))
        & F.col(value).eqNullSafe(F.lag(value).over(order))
    )
    laned = partials.withColumn("_lane", F.when(~F.col("edge"), F.col("_piece")))
    marked = laned.withColumn("_starts", F.when(continues, 0).otherwise(1)).withColumn(
        "_latest", F.col("edge") & F.lead(F.lit(True)).over(order).isNull()
    )
    return (
        marked.withColumn("_whole", F.sum("_starts").over(_so_far(order)))
        .groupBy(key, "_lane", "_whole", value)
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("readings").alias("readings"),
            F.sum("carried").alias("carried"),
            F.max("_latest").alias("latest"),
        )
        .drop("_lane", "_whole")
    )


def stuck_runs(
    df: DataFrame,
    key: str = "sensor_id",
    ts: str = "ts",
    id: str = "event_id",
    value: str = "temperature",
    min_readings: int = STUCK_READINGS,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Runs of at least ``min_readings`` consecutive equal values, one row each.

    A null or NaN reading ends a run; a run of them is missing data, not a stuck sensor.
    """
    partials = partial_runs(df, key, ts, id, value, rows_per_task, broadcast_bytes)
    kept = partials.filter(F.col("edge") | (F.col("readings") >= min_readings))
    runs = stitched_runs(kept, key, value)
    long_enough = (F.col("readings") >= min_readings) & is_reading(df, value)
    return runs.filter(long_enough).select(key, "start", "end", "readings", value)


def label_anomalies(
    df: DataFrame,
    key: str = "sensor_id",
    ts: str = "ts",
    id: str = "event_id",
    value: str = "temperature",
    repeated: str | None = None,
    n: int = TRAILING_READINGS,
    threshold: float = SPIKE_JUMP,
    min_readings: int = STUCK_READINGS,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``is_spike``, ``is_stuck`` and the label ``is_anomaly`` (either, as 0/1) to every reading.

    ``repeated`` is the column watched for repeats if it is not ``value``. A reading is in a run of
    ``min_readings`` exactly if it is in one within ``min_readings - 1`` readings to both sides, so
    both flags come from one shuffle with that much overlap between pieces, without joining back.
    """
    repeated = repeated or value
    reach = min_readings - 1
    cut = in_pieces(df, key, [ts, id], max(n, reach), reach, rows_per_task, broadcast_bytes)
    order = Window.partitionBy(key, "_piece").orderBy(ts, id)
    same_run = Window.partitionBy(key, "_piece", "_run")
    numbered = cut.withColumn("is_spike", _is_spike(order, value, n, threshold)).withColumn(
        "_starts", _starts_run(order, repeated)
    )
    sized = numbered.withColumn("_run", F.sum("_starts").over(_so_far(order))).withColumn(
        "is_stuck", (F.count("*").over(same_run) >= min_readings) & is_reading(df, repeated)
    )
    either = (F.col("is_spike") | F.col("is_stuck")).cast("int")
    kept = [c for c in df.columns if c not in ("is_spike", "is_stuck", LABEL)]
    return sized.filter("_own").select(*kept, "is_spike", "is_stuck", either.alias(LABEL))
