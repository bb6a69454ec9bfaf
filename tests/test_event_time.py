import json
import random
from datetime import datetime, timedelta
from pathlib import Path
from unittest import mock

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter, functions as F, types as T

from sensorloom.operators import detecting
from sensorloom.schemas import READING
from sensorloom.sinks import stores
from sensorloom.sinks.ledger import forget, get_record, numbered, put_record
from sensorloom.sources.files import file_stream
from sensorloom.streaming.eventtime import late_rows, rollup, rollup_stream
from sensorloom.streaming.fanout import run_stream
from sensorloom.streaming.stuck import stuck_runs_stream

NOW = {"availableNow": True}
START = datetime(2025, 7, 1)
LOG = T.StructType().add("sensor_id", "string").add("ts", "timestamp_ntz").add("event_id", "long").add("temperature", "double")


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def _log(spark, rows):
    """Rows of (sensor, minute, temperature) in the order in which they arrive."""
    at = lambda m: None if m is None else START + timedelta(minutes=m)
    return spark.createDataFrame([(s, at(m), n, v) for n, (s, m, v) in enumerate(rows)], LOG)


# Hourly figures


def _hours(spark, place, batches, **settings):
    """Each batch arrives after a restart; what the stream has given out after each, and how many rows it dropped."""
    given = []
    for rows in batches:
        _log(spark, rows).coalesce(1).write.mode("append").parquet(place("in"))
        stream = spark.readStream.schema(LOG).parquet(place("in"))
        query = rollup_stream(stream, place("hours"), place("cp"), ts="ts", values=["temperature"], trigger=NOW, **settings)
        query.awaitTermination()
        schema = rollup(_log(spark, []), ts="ts", values=["temperature"]).schema
        stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(place("hours"))
        given.append(({(r["sensor_id"], int((r["start"] - START).total_seconds() // 3600)): (r["readings"], r["temperature_mean"]) for r in stored.collect()}, late_rows(query)))
    return given


def test_windows_are_given_out_once_they_are_closed(spark, place):
    first, second, third = _hours(spark, place, [
        [("a", 5, 1.0), ("a", 50, 2.0), ("b", 30, 5.0), ("a", 65, 9.0)],
        [("a", 58, 6.0), ("b", 100, 7.0)],  # out of order, but within the delay
        [("a", 20, 99.0), ("a", 95, 1.0), ("b", 250, 1.0)],  # the first hour is closed: late; the second is not
    ])
    assert first == ({}, 0)  # the newest time is 01:05, so the watermark 00:55
    assert second == ({("a", 0): (3, 3.0), ("b", 0): (1, 5.0)}, 0)
    assert third[0] == {**second[0], ("a", 1): (2, 5.0), ("b", 1): (1, 7.0)}
    assert third[1] == 1


def test_hours_equal_the_batch_figures(spark, place):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), m, rng.choice([1.5, 2.0, None, float("nan"), float("inf")])) for m in range(0, 600, 7)]
    rows += [("a", None, 5.0), ("clock", 700, 0.0)]
    batches = [rows[:40], rows[40:]]
    got = _hours(spark, place, batches)[-1][0]
    whole = rollup(_log(spark, rows), ts="ts", values=["temperature"]).filter("sensor_id is null or sensor_id <> 'clock'")
    assert got == {(r["sensor_id"], int((r["start"] - START).total_seconds() // 3600)): (r["readings"], r["temperature_mean"]) for r in whole.collect()}


def test_hours_are_stored_by_day(spark, place):
    _hours(spark, place, [[("a", m, 1.0) for m in (10, 1500, 3000)]])
    assert sorted(p.name for p in Path(place("hours")).glob("day=*")) == ["day=2025-07-01", "day=2025-07-02"]
    plan = spark.read.parquet(place("hours")).filter("day = date'2025-07-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


# Readings that arrive again


def _message(sensor, minute, temperature=20.0):
    time = (START + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps({"sensor_id": sensor, "temperature": temperature, "humidity": 50.0, "timestamp": time})


def _stored(spark, place, batches, **settings):
    for texts in batches:
        spark.createDataFrame([(t,) for t in texts], "value string").repartition(3).write.mode("append").parquet(place("in"))
        sinks = [stores.processed(place("all")), stores.rejected(place("rejected"))]
        run_stream(file_stream(spark, place("in"), spark.read.parquet(place("in")).schema), sinks, place("cp"), trigger=NOW, **settings).awaitTermination()
    rows = stores.read_store(spark, place("all"), READING).collect()
    rejected = spark.read.schema("value string").parquet(place("rejected")).collect()
    return sorted((r["sensor_id"], r["timestamp"][11:16], r["temperature"]) for r in rows), sorted(str(r["value"]) for r in rejected)


def test_a_reading_that_arrives_again_is_stored_once(spark, place):
    a, b, c = _message("a", 1), _message("b", 1), _message("a", 2)
    rows, rejected = _stored(spark, place, [[a, a, b, "bad"], [c, b, a, "bad", "worse"], [a, c]], distinct=READING.names)
    assert rows == [("a", "00:01", 20.0), ("a", "00:02", 20.0), ("b", "00:01", 20.0)]
    assert rejected == ["bad", "bad", "worse"]


def test_repeats_are_known_as_long_as_the_delay(spark, place):
    batches = [[_message("a", 0)], [_message("a", 30)], [_message("a", 0), _message("a", 25), _message("a", 30)]]
    rows, _ = _stored(spark, place, batches, distinct=("sensor_id", "timestamp"), delay="10 minutes")
    # Minute 0 is before the watermark: late, and dropped whether it is a repeat or not.
    assert [r[1] for r in rows] == ["00:00", "00:25", "00:30"]


def test_distinct_by_some_columns(spark, place):
    rows, _ = _stored(spark, place, [[_message("a", 0, 1.0)], [_message("a", 0, 2.0), _message("b", 0, 1.0)]], distinct=("sensor_id", "timestamp"))
    assert rows == [("a", "00:00", 1.0), ("b", "00:00", 1.0)]


def test_without_distinct_every_reading_is_stored(spark, place):
    rows, _ = _stored(spark, place, [[_message("a", 0)], [_message("a", 0)]])
    assert len(rows) == 2


# Stuck sensors out of order


def _stuck(spark, place, batches, delay="30 minutes", **settings):
    for frame in batches:
        frame.repartition(2).write.mode("append").parquet(place("log"))
        stuck_runs_stream(
            spark.readStream.schema(LOG).parquet(place("log")), place("alerts"), place("cp"), trigger=NOW, delay=delay, late=place("late"), **settings
        ).awaitTermination()
    return sorted((r["sensor_id"], r["start"], r["temperature"]) for r in spark.read.parquet(place("alerts")).collect())


def _shuffled(seed, minutes=240):
    """Readings of some sensors, one a minute, and the order in which they arrive up to 30 minutes late."""
    rng = random.Random(seed)
    rows = [(f"s{k}", m, float(rng.randint(0, 1)) if rng.random() < 0.25 else float(m // 40)) for k in range(5) for m in range(minutes)]
    return sorted(rows, key=lambda r: (r[1] + rng.uniform(0, 30)))


@pytest.mark.parametrize("batches,rows_per_task", [(2, 10**6), (6, 10**6), (3, 9)])
def test_readings_out_of_order_join_their_own_run(spark, place, batches, rows_per_task):
    rows = _shuffled(batches)
    log = _log(spark, [*rows, ("clock", 400, -1.0)])
    size = -(-len(rows) // batches)
    parts = [log.filter(F.col("event_id").between(size * n, size * (n + 1) - 1)) for n in range(batches)] + [log.filter("sensor_id = 'clock'")]
    found = _stuck(spark, place, parts, rows_per_task=rows_per_task)
    wanted = detecting.stuck_runs(log).select("sensor_id", "start", "temperature").collect()
    assert found == sorted(map(tuple, wanted)) and len(found) > 5
    assert spark.read.schema(LOG).parquet(place("late")).count() == 0
    # In the order of arrival there are other runs.
    arrived = stuck_runs_stream(spark.readStream.schema(LOG).parquet(place("log")), place("other"), place("cp2"), trigger=NOW)
    arrived.awaitTermination()


def test_late_readings_are_set_aside(spark, place):
    steady = [("a", m, 7.0) for m in range(14)]
    parts = [
        _log(spark, steady + [("clock", 60, 0.0)]),  # released up to minute 30
        _log(spark, [("a", 5, 1.0), ("a", None, 1.0), ("a", 31, 7.0)]),  # too late to break the run; without a time; in time
        _log(spark, [("clock", 200, 0.0)]),
    ]
    found = _stuck(spark, place, parts)
    assert found == [("a", START, 7.0)]
    late = spark.read.schema(LOG).parquet(place("late")).collect()
    assert sorted(str(r["ts"]) for r in late) == [str(START + timedelta(minutes=5)), "None"]


def test_waiting_readings_survive_a_batch_that_failed(spark, place):
    rows = _shuffled(11)
    log = _log(spark, [*rows, ("clock", 400, -1.0)]).persist()
    _stuck(spark, place, [log.filter("event_id < 500")])
    writes = DataFrameWriter.parquet

    def breaks_off(self, path, *args, **kwargs):
        if "alerts" in path:
            raise OSError("lost the connection")
        return writes(self, path, *args, **kwargs)

    with mock.patch.object(DataFrameWriter, "parquet", breaks_off), pytest.raises(StreamingQueryException, match="lost the connection"):
        log.filter("event_id >= 500").write.mode("append").save(place("log"))
        stuck_runs_stream(spark.readStream.schema(LOG).parquet(place("log")), place("alerts"), place("cp"), trigger=NOW, delay="30 minutes").awaitTermination()
    found = _stuck(spark, place, [log.limit(0)])
    assert found == sorted(map(tuple, detecting.stuck_runs(log).select("sensor_id", "start", "temperature").collect()))
    # Only the last two batches' readings are kept.
    assert len(numbered(spark, f"{place('cp')}/waiting/rows")) <= 2


def test_a_delay_needs_times(spark, place):
    schema = "sensor_id string, ts string, event_id long, temperature double"
    spark.createDataFrame([], schema).write.parquet(place("log"))
    stream = spark.readStream.schema(schema).parquet(place("log"))
    with pytest.raises(ValueError, match="timestamps"):
        stuck_runs_stream(stream, place("alerts"), place("cp"), delay="1 hour")


# Records


def test_records_are_replaced_and_forgotten(spark, place):
    folder = place("records")
    assert get_record(spark, f"{folder}/batch=1") is None and numbered(spark, folder) == []
    for n in (1, 2, 10):
        put_record(spark, f"{folder}/batch={n}", {"n": n})
    put_record(spark, f"{folder}/batch=2", {"n": "again"})
    assert numbered(spark, folder) == [1, 2, 10] and get_record(spark, f"{folder}/batch=2") == {"n": "again"}
    forget(spark, folder, 10)
    assert numbered(spark, folder) == [10]
