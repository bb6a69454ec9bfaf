"""Stuck sensors on a live stream.

A keyed state function would hand all of one sensor's readings in a batch to one task. Here every
batch goes through the batch detector, which can cut a busy sensor's readings into pieces, and
the only state is each sensor's latest run, one row per sensor, in buckets by a hash of the sensor. A
batch reads and rewrites the buckets of its own sensors alone.

With a delay, readings first wait next to the checkpoint until the newest time seen is that far past
their own, so that readings which arrive out of order take their place in the sensor's history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators.detecting import STUCK_READINGS, is_reading, partial_runs, stitched_runs
from sensorloom.operators.ordering import ROWS_PER_TASK
from sensorloom.session import scratch_scope
from sensorloom.sinks.ledger import forget, get_record, numbered, put_record
from sensorloom.streaming.fanout import checkpoint_run


#: Buckets of the state, and how long a silent sensor is remembered where times are timestamps.
BUCKETS = 64
FORGET_AFTER = "30 days"


class _State:
    """Latest runs per bucket, in two slots of which the newer one counts.

    Every row says which batch wrote it. A batch reads of each bucket the newest slot written before it
    and replaces the other one, so a replayed batch finds its own input unchanged.
    """

    def __init__(self, spark: SparkSession, path: str, rows: T.StructType, batch_id: int):
        extra = "batch bigint, marker boolean, bucket int, slot int"
        self.schema = T.StructType([*rows.fields, *T.StructType.fromDDL(extra).fields])
        self.spark, self.path, self.rows, self.batch_id = spark, path, rows, batch_id
        if batch_id == 0:
            empty = spark.createDataFrame([], self.schema)
            empty.write.mode("append").partitionBy("bucket", "slot").parquet(path)

    def read(self, buckets: Sequence[int]) -> DataFrame:
        """The latest runs of these buckets."""
        stored = self.spark.read.schema(self.schema).parquet(self.path).filter(F.col("bucket").isin(*buckets) & (F.col("batch") < self.batch_id))
        # At most two slots per bucket pass through the driver.
        newest = stored.groupBy("bucket").agg(F.max_by("slot", "batch").alias("slot")).collect()
        self.current = {row["bucket"]: row["slot"] for row in newest}
        wanted = F.lit(False)
        for bucket, slot in self.current.items():
            wanted = wanted | ((F.col("bucket") == bucket) & (F.col("slot") == slot))
        return stored.filter(wanted & ~F.col("marker")).select(*self.rows.names)

    def replace(self, latest: DataFrame, key: str, buckets: Sequence[int]) -> None:
        """Store the latest runs of these buckets, and a marker in each so that an empty one counts too."""
        slots = F.create_map(*[F.lit(x) for b in buckets for x in (b, 1 - self.current.get(b, 1))])
        markers = self.spark.createDataFrame([(b,) for b in buckets], "bucket int").withColumn("marker", F.lit(True))
        rows = latest.withColumn("bucket", bucket_of(key)).withColumn("marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
        rows = rows.withColumns({"slot": slots[F.col("bucket")], "batch": F.lit(self.batch_id).cast("bigint")}).select(*self.schema.names)
        # Only the slots written here are replaced.
        rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "slot").parquet(self.path)


class _Waiting:
    """Readings that wait for the watermark: a folder of rows per batch, and a record that says how far it has come.

    A batch reads the newest record before it and stores its own last, so a replayed batch, or one that
    broke off, finds what the batch before it left. Only readings within the delay are ever stored.
    """

    def __init__(self, spark: SparkSession, path: str, delay: str, batch_id: int):
        self.spark, self.path, self.delay, self.batch_id = spark, path, delay, batch_id
        done = [n for n in numbered(spark, f"{path}/records") if n < batch_id]
        self.last = done[-1] if done else None
        self.record = get_record(spark, f"{path}/records/batch={self.last}") if done else {"newest": None, "released": None}

    def release(self, rows: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
        """``(readings to be taken in order now, late readings)``; the others are stored until a later batch."""
        micros = F.unix_micros(F.col(ts).cast("timestamp"))
        before, newest = self.record["released"], self.record["newest"]
        seen = [n for n in (newest, rows.agg(F.max(micros)).first()[0]) if n is not None]
        newest, released = (max(seen) if seen else None), before
        if newest is not None:
            bound = f"select unix_micros(timestamp_micros({newest}) - interval {self.delay})"
            released = max(n for n in (before, self.spark.sql(bound).first()[0]) if n is not None)
        self.next = {"newest": newest, "released": released}
        in_time = micros.isNotNull() if before is None else micros.isNotNull() & (micros > before)
        arrived = rows.filter(in_time)
        if self.last is not None:
            stored = self.spark.read.schema(rows.schema).parquet(f"{self.path}/rows/batch={self.last}")
            arrived = arrived.unionByName(stored)
        ready = F.lit(False) if released is None else micros <= released
        # Few files, as this is read and written with every batch; a large rest is not merged.
        arrived.filter(~ready).hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/rows/batch={self.batch_id}")
        return arrived.filter(ready), rows.filter(~in_time)

    def done(self) -> None:
        put_record(self.spark, f"{self.path}/records/batch={self.batch_id}", self.next)
        if self.last is not None:
            for kind in ("records", "rows"):
                forget(self.spark, f"{self.path}/{kind}", self.last)


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def stuck_runs_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "sensor_id",
    ts: str = "ts",
    id: str = "event_id",
    value: str = "temperature",
    min_readings: int = STUCK_READINGS,
    forget_after: str | None = FORGET_AFTER,
    rows_per_task: int = ROWS_PER_TASK,
    trigger: Mapping[str, object] | None = None,
    delay: str | None = None,
    late: str | None = None,
) -> StreamingQuery:
    """Append an alert ``(key, start, value)`` to ``path`` once, when a run reaches ``min_readings``.

    ``delay`` (an interval such as ``"10 minutes"``) is how far behind the newest time a reading may arrive and
    still take its place: readings are taken in the order of ``ts`` and ``id`` once the newest time seen in any batch is
    ``delay`` past their own. One that arrives after that, or has no time, is late: it is stored in the folder ``late``, if
    given, and left out. At the end of a log the last readings wait until a newer one, a heartbeat
    of any sensor, moves the time on. ``ts`` must be a timestamp then.

    Without ``delay`` nothing waits: readings are put in order within a batch, and one that arrives in a later batch than
    its successors counts as the newest. ``forget_after`` (an interval such as ``"1 day"``, or none) drops the state of
    sensors that have been silent for longer, measured against the batch's newest reading, whenever their
    bucket is written; it needs a timestamp column as ``ts`` and has no effect on times as text.

    The state lies inside the checkpoint.
    """
    runs: list[str] = []
    ages = isinstance(readings.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType))
    if delay and not ages:
        raise ValueError(f"a delay needs times as timestamps; {ts} is {readings.schema[ts].dataType.simpleString()}")

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not runs:
            runs.append(checkpoint_run(spark, checkpoint))
        arriving = rows = batch.select(*dict.fromkeys([key, ts, id, value])).persist()
        found = None
        try:
            with scratch_scope(spark):
                if delay:
                    waiting = _Waiting(spark, f"{checkpoint}/waiting", delay, batch_id)
                    rows, behind = waiting.release(arriving, ts)
                    rows = rows.persist()
                    if late:
                        behind.write.mode("overwrite").parquet(f"{late}/run={runs[0]}/batch={batch_id}")
                partials = partial_runs(rows, key, ts, id, value, rows_per_task)
                partials = partials.filter(F.col("edge") | (F.col("readings") >= min_readings))
                kinds = {**{c: rows.schema[c].dataType for c in (key, value)}, "start": rows.schema[ts].dataType, "end": rows.schema[ts].dataType}
                schema = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()]).add("readings", "long")
                state = _State(spark, f"{checkpoint}/latest_runs", schema, batch_id)
                touched = sorted(row[0] for row in rows.select(bucket_of(key)).distinct().collect())
                known = state.read(touched)
                newest = rows.agg(F.max(ts)).first()[0] if forget_after and ages else None
                if newest is not None:
                    known = known.filter(F.col("end") >= F.lit(newest) - F.expr(f"interval {forget_after}"))
                before_all = {"_piece": F.lit(-1).cast("bigint"), "run": F.lit(0).cast("bigint"),
                              "carried": F.col("readings"), "edge": F.lit(True)}
                partials = partials.unionByName(known.withColumns(before_all))
                found = stitched_runs(partials, key, value).persist()
                reached = (F.col("readings") >= min_readings) & (F.col("carried") < min_readings)
                alerts = found.filter(reached & is_reading(found, value)).select(key, "start", value)
                alerts.write.mode("overwrite").parquet(f"{path}/run={runs[0]}/batch={batch_id}")
                if touched:
                    state.replace(found.filter("latest").select(*schema.names), key, touched)
                if delay:
                    waiting.done()
        finally:
            for frame in (arriving, rows):
                frame.unpersist()
            if found is not None:
                found.unpersist()

    writer = (
        readings.writeStream.foreachBatch(advance)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
