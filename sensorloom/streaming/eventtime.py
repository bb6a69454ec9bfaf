"""Event time on the stream: figures per sensor and hour, and readings that arrive more than once.

Both hold state only for times that the watermark has not passed: the newest event time seen so far, less
a delay. What arrives later than that is late: it changes no figures that were already given out,
and is not told apart from a repeat.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions.numbers import finite
from sensorloom.functions.times import from_iso
from sensorloom.schemas import FEATURES, READING

HOUR = "1 hour"
DELAY = "10 minutes"


def event_time(df: DataFrame, ts: str) -> Column:
    """The time of a reading as a timestamp, which watermarks ask for; null where text is none."""
    return from_iso(F.col(ts)) if isinstance(df.schema[ts].dataType, T.StringType) else F.col(ts).cast("timestamp")


def rollup(
    readings: DataFrame, key: str = "sensor_id", ts: str = "timestamp", values: Sequence[str] = FEATURES,
    window: str = HOUR, delay: str | None = None,
) -> DataFrame:
    """Per sensor and window its ``readings`` and each value's mean, deviation, least and greatest.

    Windows begin at whole multiples since the epoch; ``start`` and ``end`` are timestamps, without a zone if ``ts``
    is. Missing, NaN and infinite values are left out of a value's
    figures but count as readings; readings without a time are in no window. Works on a batch alike; on a stream
    ``delay`` is needed, and a busy sensor's readings are combined before they are shuffled.
    """
    timed = readings.withColumn("_time", event_time(readings, ts)).filter(F.col("_time").isNotNull())
    if delay:
        timed = timed.withWatermark("_time", delay)
    figures = []
    for value in values:
        number = finite(F.col(value).cast("double"))
        for name, figure in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            figures.append(figure(number).alias(f"{value}_{name}"))
    grouped = timed.groupBy(F.window("_time", window).alias("_window"), key).agg(F.count("*").alias("readings"), *figures)
    named = [c for c in grouped.columns if c not in ("_window", key)]
    kind = "timestamp_ntz" if isinstance(readings.schema[ts].dataType, T.TimestampNTZType) else "timestamp"
    borders = [F.col(f"_window.{c}").cast(kind).alias(c) for c in ("start", "end")]
    return grouped.select(key, *borders, *named)


def rollup_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "sensor_id",
    ts: str = "timestamp",
    values: Sequence[str] = FEATURES,
    window: str = HOUR,
    delay: str = DELAY,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append each window of :func:`rollup` to ``path`` once, when the watermark has passed its end.

    A reading more than ``delay`` older than the newest one of the batches before is late: if its window has
    been given out, it is dropped and counted (:func:`late_rows`); if the window is still open, it
    counts as usual. Windows that are open when the stream stops go on at the next start. The store is
    Spark's file sink, partitioned by ``day``, whose log makes a replayed batch stand there once.
    """
    closed = rollup(readings, key, ts, values, window, delay)
    writer = (
        closed.withColumn("day", F.to_date("start"))
        .writeStream.format("parquet")
        .partitionBy("day")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows a query has dropped as late, as far as its recent progress goes.

    Rows are counted as they reach the state: those of one window and sensor in one task are one.
    """
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])


def drop_repeats(readings: DataFrame, ids: Sequence[str] = tuple(READING.names), ts: str = "timestamp", delay: str = DELAY) -> DataFrame:
    """A stream of decoded readings (with ``valid``) in which each reading that is equal in ``ids`` stands once.

    A reading is known from its first arrival until the watermark is ``delay`` past its time, across batches and
    restarts; one older than the watermark is dropped, as its first arrival may be forgotten. Rejected messages
    have no time to go by: they pass, equal ones of one batch at most once.
    """
    keys = {f"_id{n}": F.when(F.col("valid"), F.col(c)) for n, c in enumerate(ids)}
    if "value" in readings.columns:
        keys["_raw"] = F.when(~F.col("valid"), F.col("value"))
    timed = readings.withColumns({"_time": F.when(F.col("valid"), event_time(readings, ts)), **keys})
    once = timed.withWatermark("_time", delay).dropDuplicatesWithinWatermark(list(keys))
    return once.drop("_time", *keys)
