import json
import shutil
import time
from pathlib import Path
from unittest import mock

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter, functions as F, types as T

from sensorloom.operators import codec, detecting
from sensorloom.plans import inputs
from sensorloom.schemas import LINE, READING, SCORED
from sensorloom.sinks import stores
from sensorloom.sinks.compaction import compact_store
from sensorloom.sources.files import file_stream
from sensorloom.streaming.fanout import checkpoint_run, read_stream, run_stream
from sensorloom.streaming.stuck import bucket_of, stuck_runs_stream

NOW = {"availableNow": True}


def _message(n, temperature=20.0):
    return json.dumps({"sensor_id": f"s{n % 3}", "temperature": temperature, "humidity": 50.0 + n, "timestamp": f"2025-07-01T00:00:{n:02d}Z"})


def _arrive(spark, folder, texts, partitions=2):
    frame = spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary"))
    frame.repartition(partitions).write.mode("append").parquet(str(folder))


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def _run(spark, place, sinks, **settings):
    stream = file_stream(spark, place("in"), max_files_per_trigger=settings.pop("files", None))
    run_stream(stream, sinks, place("checkpoint"), trigger=NOW, **settings).awaitTermination()


def _stored(spark, place, name, schema=READING):
    return sorted(map(tuple, stores.read_store(spark, place(name), schema).collect()), key=repr)


def test_fan_out_equals_batch(spark, place):
    texts = [_message(n, 20.0 + 30 * n) for n in range(12)] + ["not json", '{"sensor_id":"x"}', None]
    _arrive(spark, place("in"), texts, partitions=5)
    sinks = [stores.processed(place("all")), stores.anomalies(place("bad")), stores.series(place("lines")), stores.rejected(place("rejected"))]
    _run(spark, place, sinks, model=inputs.rule_model(), metrics=place("metrics"), files=2)

    batch = read_stream(spark.read.parquet(place("in")), inputs.rule_model())
    for name, rows, schema in (("all", stores.valid_rows, SCORED), ("bad", stores.anomalous_rows, SCORED)):
        assert _stored(spark, place, name, schema) == sorted(map(tuple, rows(batch).collect()), key=repr)
    lines = stores.read_store(spark, place("lines"), LINE, "text").collect()
    assert sorted(lines) == sorted(stores.point_lines(batch).collect())
    assert len(lines) == 12
    assert {r["value"] for r in spark.read.parquet(place("rejected")).collect()} == {"not json", '{"sensor_id":"x"}', None}
    metrics = spark.read.parquet(place("metrics"))
    assert tuple(metrics.agg(F.sum("readings"), F.sum("rejected"), F.sum("anomalies")).first()) == (15, 3, len(_stored(spark, place, "bad", SCORED)))
    assert metrics.count() == 3


def test_counts_cover_all_partitions_of_a_batch(spark, place):
    _arrive(spark, place("in"), [_message(n) for n in range(40)], partitions=8)
    _run(spark, place, [stores.processed(place("all"))], metrics=place("metrics"))
    assert [r["readings"] for r in spark.read.parquet(place("metrics")).collect()] == [40]


def test_restart_resumes_where_it_stopped(spark, place):
    sinks = [stores.processed(place("all"))]
    _arrive(spark, place("in"), [_message(n) for n in range(5)])
    _run(spark, place, sinks)
    _arrive(spark, place("in"), [_message(n) for n in range(5, 9)])
    _run(spark, place, sinks)
    assert len(_stored(spark, place, "all")) == 9
    batches = {r["batch"] for r in spark.read.parquet(place("all")).select("batch").distinct().collect()}
    assert batches == {0, 1}


def test_a_new_checkpoint_does_not_overwrite_older_batches(spark, place):
    _arrive(spark, place("in"), [_message(n) for n in range(5)])
    for checkpoint in ("one", "two"):
        run_stream(file_stream(spark, place("in")), [stores.processed(place("all"))], place(checkpoint), trigger=NOW).awaitTermination()
    assert len(_stored(spark, place, "all")) == 10


def _failing(frame):
    raise ValueError("store is down")


def test_a_failing_sink_neither_stops_the_others_nor_loses_rows(spark, place):
    _arrive(spark, place("in"), [_message(n) for n in range(5)])
    broken = stores.Sink("late", _failing, path=place("late"))
    with pytest.raises(StreamingQueryException, match="1 of 2 sinks failed"):
        _run(spark, place, [broken, stores.processed(place("all"))])
    assert len(_stored(spark, place, "all")) == 5

    _run(spark, place, [stores.Sink("late", stores.valid_rows, path=place("late")), stores.processed(place("all"))])
    assert len(_stored(spark, place, "late")) == 5
    assert len(_stored(spark, place, "all")) == 5  # replayed into the same folder


def test_every_failure_is_reported(spark):
    frame = spark.range(1)
    with pytest.raises(ExceptionGroup) as raised:
        stores.write_batch(frame, 3, [stores.Sink("a", _failing), stores.Sink("b", _failing)], "r")
    assert [f.__notes__ for f in raised.value.exceptions] == [["while writing batch 3 to sink a"], ["while writing batch 3 to sink b"]]


def test_replaying_a_batch_replaces_it(spark, place):
    frame = read_stream(spark.createDataFrame([(_message(n),) for n in range(8)], "value string"))
    for _ in range(2):
        stores.write_batch(frame, 0, [stores.processed(place("all"))], "r")
    assert len(_stored(spark, place, "all")) == 8


def test_document_store_options():
    sink = stores.document_store("anomalies", stores.anomalous_rows, "mongodb://db", "telemetry", operationType="replace")
    assert sink.format == "mongodb" and sink.path is None
    assert sink.options == {"connection.uri": "mongodb://db", "database": "telemetry", "collection": "anomalies", "operationType": "replace"}


@pytest.mark.parametrize("broken_off", [False, True])
def test_small_batches_are_merged(spark, place, broken_off):
    for k in range(6):
        _arrive(spark, place("in"), [_message(n) for n in range(5 * k, 5 * k + 5)], partitions=1)
    sinks = [stores.processed(place("all"))]
    _run(spark, place, sinks, files=1)
    before = _stored(spark, place, "all")
    if broken_off:
        # The merged rows are there, and half of the old folders gone.
        run = next(Path(place("all")).glob("run=*"))
        spark.read.parquet(place("all")).filter("batch < 5").select(*READING.names).coalesce(1).write.parquet(f"{run}/_merged=4")
        for n in (0, 1):
            shutil.rmtree(run / f"batch={n}")
    assert compact_store(spark, place("all"), READING) == (0 if broken_off else 4)
    assert _stored(spark, place, "all") == before
    folders = sorted(p.name for p in Path(place("all")).glob("run=*/*"))
    assert folders == ["batch=4", "batch=5"]
    assert len(list(Path(place("all")).glob("run=*/batch=4/*.parquet"))) == 1
    # A replay of the newest batch and new batches go on as before.
    run = next(Path(place("all")).glob("run=*")).name.removeprefix("run=")
    newest = spark.read.parquet(place("all")).filter("batch = 5").select(*READING.names).withColumn("valid", F.lit(True)).persist()
    newest.count()
    stores.write_batch(newest, 5, sinks, run)
    assert _stored(spark, place, "all") == before
    _arrive(spark, place("in"), [_message(40)], partitions=1)
    _run(spark, place, sinks)
    assert len(_stored(spark, place, "all")) == len(before) + 1
    assert compact_store(spark, place("nothing"), READING) == 0


# Stuck sensors on a stream

LOG = T.StructType().add("sensor_id", "string").add("ts", "timestamp_ntz").add("event_id", "long").add("temperature", "double")


def _log(spark, histories):
    rows = [(s, n, float(v)) for s, values in histories.items() for n, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "sensor_id string, event_id long, temperature double")
    return frame.select("sensor_id", F.expr("timestamp_ntz'2025-01-01' + make_interval(0,0,0,0,0,event_id)").alias("ts"), "event_id", "temperature")


def _stuck(spark, place, log, cuts, **settings):
    for low, high in zip([-1, *cuts], [*cuts, 10**9]):
        log.filter(F.col("event_id").between(low + 1, high)).repartition(2).write.mode("append").parquet(place("log"))
        stuck_runs_stream(
            spark.readStream.schema(LOG).parquet(place("log")), place("alerts"), place("checkpoint"), trigger=NOW, **settings
        ).awaitTermination()
    return sorted((r["sensor_id"], r["start"].minute * 60 + r["start"].second, r["temperature"]) for r in spark.read.parquet(place("alerts")).collect())


HISTORIES = {
    "over a border": [1] * 3 + [2] * 20 + [1] * 3,
    "silent in between": [7] * 5,
    "twice": [4] * 15 + [5] + [4] * 15,
    "always": [9] * 60,
    "moving": list(range(60)),
}


@pytest.mark.parametrize("cuts", [[], [9], [4, 9, 14, 19, 24, 29]])
@pytest.mark.parametrize("rows_per_task", [10**6, 4])
def test_stuck_stream_alerts_once_per_run(spark, place, cuts, rows_per_task):
    log = _log(spark, HISTORIES)
    found = _stuck(spark, place, log, cuts, rows_per_task=rows_per_task)
    wanted = detecting.stuck_runs(log).collect()
    assert found == sorted((r["sensor_id"], r["start"].minute * 60 + r["start"].second, r["temperature"]) for r in wanted)
    assert len(found) == 4


@pytest.mark.parametrize("fails_at", ["latest_runs", "alerts"])
def test_stuck_stream_replays_a_batch_that_failed(spark, place, fails_at):
    """The second batch breaks off while it writes; its replay finds the first one's state unchanged."""
    log = _log(spark, HISTORIES)
    _stuck(spark, place, log.filter("event_id <= 9"), [])
    writes = DataFrameWriter.parquet

    def breaks_off(self, path, *args, **kwargs):
        if fails_at in path:
            raise OSError("lost the connection")
        return writes(self, path, *args, **kwargs)

    with mock.patch.object(DataFrameWriter, "parquet", breaks_off), pytest.raises(StreamingQueryException, match="lost the connection"):
        log.filter("event_id > 9").write.mode("append").save(place("log"))
        stuck_runs_stream(spark.readStream.schema(LOG).parquet(place("log")), place("alerts"), place("checkpoint"), trigger=NOW).awaitTermination()
    stuck_runs_stream(spark.readStream.schema(LOG).parquet(place("log")), place("alerts"), place("checkpoint"), trigger=NOW).awaitTermination()
    found = spark.read.parquet(place("alerts")).select("sensor_id", "start", "temperature").collect()
    assert sorted(found) == sorted(detecting.stuck_runs(log).select("sensor_id", "start", "temperature").collect())


def test_stuck_stream_on_decoded_messages(spark, place):
    """Messages carry no id and their time as text; both detectors take that as it is."""
    messages = [_message(0).replace(":00Z", f":{n:02d}Z") for n in range(20)] + ["broken"] * 20
    for part in (messages[:7], messages[7:]):
        _arrive(spark, place("in"), part)
        readings, _ = codec.split_valid(codec.decode_json(file_stream(spark, place("in"))))
        stuck_runs_stream(readings, place("alerts"), place("checkpoint"), ts="timestamp", id="timestamp", trigger=NOW).awaitTermination()
    alerts = spark.read.parquet(place("alerts")).drop("run", "batch").collect()
    assert [tuple(r) for r in alerts] == [("s0", "2025-07-01T00:00:00Z", 20.0)]


def test_stuck_stream_forgets_silent_sensors(spark, place):
    log = _log(spark, {"s": [1.0] * 20, "clock": range(200)})
    gap = log.filter("sensor_id = 'clock' or event_id < 10").unionByName(
        log.filter("sensor_id = 's' and event_id >= 10").withColumn("event_id", F.col("event_id") + 150)
    )
    assert _stuck(spark, place, gap, [9, 140], forget_after="60 seconds") == []


def test_untouched_state_is_not_rewritten(spark, place):
    """A batch rewrites the buckets of its own sensors, and of these the slot that is not in use."""
    log = _log(spark, {f"s{i}": [1.0] * 30 for i in range(40)})
    _stuck(spark, place, log.filter("event_id < 10"), [])
    files = lambda: {p.relative_to(place("checkpoint")).parent.as_posix(): p.name for p in Path(place("checkpoint"), "latest_runs").glob("bucket=*/slot=*/*.parquet")}
    before = files()
    assert {p.split("/")[-1] for p in before} == {"slot=0"}
    one = log.filter("event_id >= 10 and sensor_id = 's7'")
    one.write.mode("append").parquet(place("log"))
    found = _stuck(spark, place, log.limit(0), [])
    after = files()
    bucket = one.select(bucket_of("sensor_id")).first()[0]
    assert {p: n for p, n in after.items() if p in before} == before
    assert after.keys() - before.keys() == {f"latest_runs/bucket={bucket}/slot=1"}
    assert [f[0] for f in found] == ["s7"]


def test_scratch_is_removed_after_each_batch(spark, place):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("sorted-*"))
    _stuck(spark, place, _log(spark, HISTORIES), [9], rows_per_task=4)
    assert set(shared.glob("sorted-*")) == before


def test_checkpoint_run_is_the_query_id(spark, place):
    _arrive(spark, place("in"), [_message(1)])
    query = run_stream(file_stream(spark, place("in")), [stores.processed(place("all"))], place("checkpoint"), trigger=NOW)
    query.awaitTermination()
    assert checkpoint_run(spark, place("checkpoint")) == query.id


def test_live_trigger(spark, place):
    """Without a trigger the stream goes on by itself until it is stopped."""
    _arrive(spark, place("in"), [_message(1)])
    query = run_stream(file_stream(spark, place("in")), [stores.processed(place("all"))], place("checkpoint"))
    try:
        query.processAllAvailable()
        _arrive(spark, place("in"), [_message(2)])
        time.sleep(0.1)
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(_stored(spark, place, "all")) == 2


def test_stream_decoding_equals_batch(spark, place):
    _arrive(spark, place("in"), [_message(n) for n in range(9)] + ["broken"], partitions=3)
    decoded = codec.decode_json(file_stream(spark, place("in"), max_files_per_trigger=1))
    decoded.writeStream.option("checkpointLocation", place("checkpoint")).trigger(**NOW).start(place("out")).awaitTermination()
    batch = codec.decode_json(spark.read.parquet(place("in")))
    assert sorted(map(tuple, spark.read.parquet(place("out")).collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
