"""Profiles kept up to date by a stream, and stores laid out by day."""

import json
import math
import random
import statistics
from datetime import date, datetime, timedelta
from pathlib import Path
from unittest import mock

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorloom.operators import profiles as batch
from sensorloom.schemas import READING
from sensorloom.sinks import stores
from sensorloom.sinks.compaction import compact_store
from sensorloom.streaming import profiles
from sensorloom.streaming.fanout import read_stream

NOW = {"availableNow": True}
START = datetime(2025, 7, 1)
SCHEMA = "sensor_id string, ts timestamp_ntz, temperature double, humidity float"


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def _near(got, wanted):
    got, wanted = ({(r["sensor_id"], r.get("hour")): r for r in (x.asDict() for x in rows)} for rows in (got, wanted))
    assert got.keys() == wanted.keys()
    for k, row in wanted.items():
        for name, value in row.items():
            if isinstance(value, float) and math.isnan(value):
                assert math.isnan(got[k][name])
            else:
                assert got[k][name] == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value), (k, name)


def _readings(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        at = None if rng.random() < 0.02 else START + timedelta(minutes=rng.randrange(3000))
        yield (rng.choice(["a", "a", "a", "b", None]), at, rng.choice([None, rng.gauss(20, 5)]), rng.gauss(50, 1))


def test_moments_merge_without_loss(spark):
    rng = random.Random(1)
    values = [1e9 + rng.gauss(0, 1) for _ in range(4000)]  # sums of squares would have lost everything here
    df = spark.createDataFrame([("a", v, n % 7) for n, v in enumerate(values)], "s string, x double, part int")
    tables = [profiles.moments(df.filter(F.col("part") == n), ["s"], ["x"]) for n in range(7)]
    kept = tables[0]
    for table in tables[1:]:
        kept = profiles.merged(kept, table, ["s"], ["x"])
    row = profiles.as_profile(kept, ["x"]).first()
    assert row["readings"] == 4000 and row["x_mean"] == pytest.approx(statistics.fmean(values), rel=1e-15)
    assert row["x_std"] == pytest.approx(statistics.stdev(values), rel=1e-6)
    coarse = profiles.coarser(profiles.moments(df, ["s", "part"], ["x"]), ["s"], ["x"])
    assert profiles.as_profile(coarse, ["x"]).first()["x_std"] == pytest.approx(statistics.stdev(values), rel=1e-6)


def test_groups_of_one_side_and_missing_values(spark):
    schema = "s string, x double"
    one = profiles.moments(spark.createDataFrame([("a", 1.0), ("b", None), (None, 3.0), ("n", float("nan"))], schema), ["s"], ["x"])
    two = profiles.moments(spark.createDataFrame([("a", 4.0), ("b", 5.0), ("c", None), (None, 5.0), ("n", 1.0)], schema), ["s"], ["x"])
    got = {r["s"]: (r["readings"], r["x_mean"], r["x_std"]) for r in profiles.as_profile(profiles.merged(one, two, ["s"], ["x"]), ["x"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": 2, "b": 2, "c": 1, None: 2, "n": 2}
    assert got["a"][1:] == (2.5, pytest.approx(statistics.stdev([1, 4]))) and got["b"][1:] == (5.0, None) and got["c"][1:] == (None, None)
    assert got[None][1] == 4.0 and math.isnan(got["n"][1])


@pytest.mark.parametrize("batches", [1, 3])
def test_kept_profiles_equal_the_batch(spark, place, batches):
    rows = list(_readings(batches, 900)) + [("late", START - timedelta(days=9), 1.0, 2.0)]
    for n in range(batches):
        spark.createDataFrame(rows[n::batches], SCHEMA).write.mode("append").parquet(place("in"))
        profiles.profile_stream(spark.readStream.schema(SCHEMA).parquet(place("in")), place("kept"), place("cp"), trigger=NOW).awaitTermination()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = profiles.daily_profile(spark, place("kept"))
    assert kept.columns == batch.daily_profile(df).columns
    _near(kept.collect(), batch.daily_profile(df).collect())
    _near(profiles.baseline(spark, place("kept")).collect(), batch.baseline(df).collect())
    assert len(list(Path(place("kept"), "rows").iterdir())) <= 2


def test_a_replayed_batch_counts_no_reading_twice(spark, place):
    rows = list(_readings(5, 300))
    spark.createDataFrame(rows[:200], SCHEMA).write.parquet(place("in"))
    run = lambda: profiles.profile_stream(spark.readStream.schema(SCHEMA).parquet(place("in")), place("kept"), place("cp"), trigger=NOW).awaitTermination()
    run()
    spark.createDataFrame(rows[200:], SCHEMA).write.mode("append").parquet(place("in"))
    recorded = profiles.put_record

    def breaks_off(*args):
        recorded(*args)
        raise OSError("lost the connection")

    with mock.patch.object(profiles, "put_record", breaks_off), pytest.raises(StreamingQueryException, match="lost"):
        run()
    run()
    _near(profiles.daily_profile(spark, place("kept")).collect(), batch.daily_profile(spark.createDataFrame(rows, SCHEMA)).collect())


def test_nothing_kept_yet(spark, place):
    with pytest.raises(ValueError, match="no batch"):
        profiles.daily_profile(spark, place("nothing"))


# Stores by day


def _frame(spark, minutes):
    texts = [json.dumps({"sensor_id": f"s{m % 3}", "temperature": 20.0, "humidity": 50.0, "timestamp": (START + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ")}) for m in minutes]
    return read_stream(spark.createDataFrame([(t,) for t in texts], "value string").repartition(4))


def _times(df):
    return sorted(int((datetime.fromisoformat(r["timestamp"][:-1]) - START).total_seconds() // 60) for r in df.collect())


def test_a_dated_store_reads_a_period(spark, place):
    sink = stores.processed(place("all"), dated="timestamp")
    minutes = list(range(0, 10_000, 37))
    for n in range(3):
        stores.write_batch(_frame(spark, minutes[n::3]), n, [sink], "r")
    stores.write_batch(_frame(spark, minutes[1::3]), 1, [sink], "r")  # a replay
    assert _times(stores.read_store(spark, place("all"), READING)) == minutes
    since, until = START + timedelta(minutes=2000), START + timedelta(days=3)
    found = stores.read_period(spark, place("all"), READING, "timestamp", since, until)
    assert found.columns == READING.names and _times(found) == [m for m in minutes if 2000 <= m < 4320]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    for f in Path(place("all")).glob("run=*/batch=*/day=2025-07-06/*.parquet"):
        f.write_bytes(b"nobody reads this")
    assert len(_times(stores.read_period(spark, place("all"), READING, "timestamp", since, until))) == len(_times(found))
    assert stores.read_period(spark, place("all"), READING, "timestamp", until, until).count() == 0


def test_files_of_a_dated_store_are_ranges_of_time(spark, place):
    stores.write_batch(_frame(spark, range(0, 1400)), 0, [stores.processed(place("all"), dated="timestamp")], "r")
    spans = []
    for f in Path(place("all")).glob("run=*/batch=*/day=*/*.parquet"):
        times = [r[0] for r in spark.read.parquet(str(f)).select("timestamp").collect()]
        assert times == sorted(times)
        spans.append((times[0], times[-1]))
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_merging_keeps_the_days(spark, place):
    sink = stores.processed(place("all"), dated="timestamp")
    minutes = list(range(0, 4000, 11))
    for n in range(5):
        stores.write_batch(_frame(spark, minutes[n::5]), n, [sink], "r")
    assert compact_store(spark, place("all"), READING, dated="timestamp") == 3
    assert sorted(p.name for p in Path(place("all")).glob("run=r/*")) == ["batch=3", "batch=4"]
    assert sorted(p.name for p in Path(place("all")).glob("run=r/batch=3/day=*")) == ["day=2025-07-01", "day=2025-07-02", "day=2025-07-03"]
    assert _times(stores.read_store(spark, place("all"), READING)) == minutes
    day = stores.read_period(spark, place("all"), READING, "timestamp", datetime(2025, 7, 2), datetime(2025, 7, 3))
    assert _times(day) == [m for m in minutes if 1440 <= m < 2880]
    stores.write_batch(_frame(spark, minutes[4::5]), 4, [sink], "r")  # the newest batch is replayed after that
    assert _times(stores.read_store(spark, place("all"), READING)) == minutes


def test_times_that_are_none_have_no_day(spark, place):
    rows = spark.createDataFrame([("a", None), ("b", datetime(2025, 7, 1, 5)), ("c", datetime(2025, 7, 2))], "s string, ts timestamp_ntz")
    stores.write_batch(rows, 0, [stores.Sink("x", lambda df: df, path=place("x"), dated="ts")], "r")
    assert stores.read_store(spark, place("x"), rows.schema).count() == 3
    found = stores.read_period(spark, place("x"), rows.schema, "ts", datetime(2025, 7, 1), datetime(2025, 7, 2))
    assert [r["s"] for r in found.collect()] == ["b"]
    assert spark.read.parquet(place("x")).filter(F.col("day") == F.lit(date(2025, 7, 2))).count() == 1
