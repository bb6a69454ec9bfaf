import io
import urllib.error
from pathlib import Path
from unittest import mock

import pyarrow as pa
import pytest

from sensorloom import session as sessions
from sensorloom.operators.codec import encode_json
from sensorloom.plans import inputs, jobs
from sensorloom.schemas import LABELLED, LINE, SCORED
from sensorloom.sinks import stores, timeseries
from sensorloom.sources import kafka
from sensorloom.sources.files import csv_sink, csv_source
from sensorloom.streaming.profiles import daily_profile as kept_profile

HEADER = "timestamp,sensor_id,temperature,humidity,is_anomaly"


def _csv(tmp_path, *lines):
    path = tmp_path / "history.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_cells(spark, tmp_path):
    path = _csv(tmp_path, HEADER, "t1,a,22.1,50.25,0", "t2,a,hot,50,1", "t3,a,1", "t4,a,1,2,0,surplus")
    read = csv_source(spark, path)
    assert read.schema == LABELLED
    assert [tuple(r)[0] for r in read.collect()] == ["t1", "t2", "t3", "t4"]
    rows = {r["timestamp"]: r for r in read.collect()}
    assert rows["t2"]["temperature"] is None and rows["t2"]["is_anomaly"] == 1
    assert rows["t3"]["humidity"] is None and rows["t3"]["is_anomaly"] is None
    assert rows["t4"]["is_anomaly"] == 0


@pytest.mark.parametrize(
    "lines",
    [
        ["sensor_id,timestamp,temperature,humidity,is_anomaly", "a,t1,1,2,0"],
        ["version https://example.org/spec/v1", "oid sha256:00", "size 1"],
    ],
)
def test_a_foreign_header_is_an_error(spark, tmp_path, lines):
    with pytest.raises(Exception, match="(?i)header"):
        csv_source(spark, _csv(tmp_path, *lines)).collect()


def test_csv_round_trip(spark, tmp_path):
    path = _csv(tmp_path, HEADER, "t1,a,22.1,50.25,0", "t2,\"b,c\",0.1,50.25,1")
    csv_sink(csv_source(spark, path), str(tmp_path / "again"))
    assert csv_source(spark, str(tmp_path / "again")).collect() == csv_source(spark, path).collect()


def test_kafka_options():
    spark = mock.MagicMock()
    kafka.kafka_source(spark, "broker:9092", "readings", max_offsets_per_trigger=1000)
    spark.readStream.format.assert_called_once_with("kafka")
    spark.readStream.format().options.assert_called_once_with(
        **{"kafka.bootstrap.servers": "broker:9092", "subscribe": "readings", "startingOffsets": "latest", "maxOffsetsPerTrigger": "1000"}
    )
    messages = mock.MagicMock()
    kafka.kafka_sink(messages, "broker:9092", "readings")
    messages.select.assert_called_once_with("value")
    messages.select().write.format().options.assert_called_once_with(**{"kafka.bootstrap.servers": "broker:9092", "topic": "readings"})


def test_kafka_stream_sink_needs_a_checkpoint():
    messages = mock.MagicMock()
    writer = kafka.kafka_stream_sink(messages, "broker:9092", "readings", "hdfs:///checkpoints/out")
    messages.select().writeStream.format.assert_called_once_with("kafka")
    messages.select().writeStream.format().options().option.assert_called_once_with("checkpointLocation", "hdfs:///checkpoints/out")
    assert writer is messages.select().writeStream.format().options().option()


def _batches(*sizes):
    n = iter(range(10**6))
    for size in sizes:
        yield pa.RecordBatch.from_pydict({"line": [f"m f={next(n)}" for _ in range(size)]})


def test_requests_hold_500_points():
    requests = list(timeseries.requests_of(_batches(3, 1200, 0, 40), 500))
    assert [len(r) for r in requests] == [500, 500, 243]
    assert [line for r in requests for line in r] == [f"m f={i}" for i in range(1243)]


def test_a_request_is_retried_only_where_that_helps():
    busy = urllib.error.HTTPError("u", 503, "busy", {}, io.BytesIO())
    refused = urllib.error.HTTPError("u", 401, "no", {}, io.BytesIO())
    params = {"org": "o", "bucket": "b", "precision": "ns"}
    with mock.patch("time.sleep"), mock.patch("urllib.request.urlopen", side_effect=[busy, busy, mock.MagicMock()]) as opened:
        timeseries.send("http://db:1/", params, "secret", ["m f=1", "m f=2"])
    request = opened.call_args.args[0]
    assert opened.call_count == 3
    assert request.full_url == "http://db:1/api/v2/write?org=o&bucket=b&precision=ns"
    assert request.data == b"m f=1\nm f=2" and request.get_header("Authorization") == "Token secret"
    with mock.patch("time.sleep"), mock.patch("urllib.request.urlopen", side_effect=refused) as opened, pytest.raises(urllib.error.HTTPError):
        timeseries.send("http://db:1", params, "secret", ["m f=1"])
    assert opened.call_count == 1


def test_a_refused_line_is_set_aside(tmp_path):
    """The rest of its request is stored, and the task goes on."""
    stored = []

    def database(request, timeout):
        lines = request.data.decode().split("\n")
        if any("bad" in line for line in lines):
            raise urllib.error.HTTPError(request.full_url, 400, "partial write", {}, io.BytesIO())
        stored.extend(lines)
        return mock.MagicMock()

    options = {"url": "http://db:1", "bucket": "b", "points": "4", "rejected": f"{tmp_path}/refused", "run": "r", "batch": "7"}
    batches = [pa.RecordBatch.from_pydict({"line": [f"m f={i}" for i in range(6)] + ["bad f=1", "m f=9", "bad f=2"]})]
    task = mock.MagicMock(**{"partitionId.return_value": 3, "taskAttemptId.return_value": 5})
    with mock.patch("urllib.request.urlopen", side_effect=database), mock.patch.object(timeseries.TaskContext, "get", return_value=task):
        for _ in range(2):
            timeseries._BatchWriter(options).write(iter(batches))
        assert sorted(set(stored)) == [f"m f={i}" for i in (0, 1, 2, 3, 4, 5, 9)]
        refused = {p.name: p.read_text() for p in Path(tmp_path, "refused").iterdir()}
        assert refused == {"r-7-00003-00001.lp": "bad f=1", "r-7-00003-00002.lp": "bad f=2"}
        with pytest.raises(urllib.error.HTTPError):
            timeseries._BatchWriter({**options, "rejected": ""}).write(iter(batches))


@pytest.mark.parametrize("address", ["file:{}", "file://{}", "{}"])
def test_series_store_writes_from_the_tasks(spark, tmp_path, sf_dir, address):
    spark.dataSource.register(timeseries.TimeSeriesDataSource)
    frame = inputs.readings(spark, sf_dir).withColumn("valid", inputs.F.lit(True)).repartition(3)
    sink = stores.series_store(address.format(f"{tmp_path}/points"), "o", "b", "t")
    for _ in range(2):  # a replay leaves each line once
        stores.write_batch(frame, 0, [sink], "r")
    stores.write_batch(frame.limit(5), 1, [sink], "r")
    requests = [path.read_text().split("\n") for path in Path(tmp_path, "points").glob("r-0-*.lp")]
    assert max(map(len, requests)) <= 500 and len(requests) >= 3
    assert sorted(line for r in requests for line in r) == sorted(r["line"] for r in stores.point_lines(frame).collect())
    assert sum(len(p.read_text().split("\n")) for p in Path(tmp_path, "points").glob("r-1-*.lp")) == 5
    assert all(p.suffix in (".lp", ".crc") for p in Path(tmp_path, "points").iterdir())


def test_series_store_as_a_stream_sink(spark, tmp_path, sf_dir):
    spark.dataSource.register(timeseries.TimeSeriesDataSource)
    lines = stores.point_lines(inputs.readings(spark, sf_dir).withColumn("valid", inputs.F.lit(True)))
    lines.write.text(str(tmp_path / "in"))
    stream = spark.readStream.schema(LINE).format("text").load(str(tmp_path / "in"))
    writer = stream.writeStream.format("timeseries").option("url", f"file:{tmp_path}/points")
    writer.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    written = [line for path in Path(tmp_path, "points").glob("*.lp") for line in path.read_text().split("\n")]
    assert sorted(written) == sorted(r["line"] for r in lines.collect())


def test_scratch_is_below_the_shared_folder():
    settings = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    cluster = mock.MagicMock()
    cluster.conf.get.side_effect = lambda name, default=None: settings.get(name, default)
    assert sessions.scratch(cluster, "x").startswith("hdfs:///warehouse/_scratch/x-")
    settings["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert sessions.scratch(cluster, "x").startswith("hdfs:///shared/x-")


@pytest.mark.parametrize("split_key", [None, "timestamp", "sensor_id,timestamp"])
def test_training_then_scoring_as_jobs(spark, tmp_path, sf_dir, split_key):
    history, model, out = (str(tmp_path / name) for name in ("history", "model", "out"))
    rows = inputs.readings(spark, sf_dir)
    csv_sink(rows.select(*LABELLED.names), history)
    report = jobs.train_job(spark, history, model, split_key, partitions=4, trees=10, depth=5).first()
    assert report["rows"] == report["train_rows"] + report["test_rows"] == rows.count() and report["unusable"] == 0
    assert report["accuracy_percent"] == f"{100 * report['accuracy']:.2f}%" and report["f1_weighted_percent"].endswith("%")
    assert report["accuracy"] > 0.9 and 0.1 < report["test_rows"] / report["rows"] < 0.3

    encode_json(rows).select(inputs.F.col("value").cast("binary")).write.parquet(str(tmp_path / "in"))
    jobs.main(["score", "--files", str(tmp_path / "in"), "--model", model, "--out", out, "--checkpoint", str(tmp_path / "c1"), "--until-caught-up"])
    assert stores.read_store(spark, f"{out}/processed_data", SCORED).count() == rows.count()
    anomalies = stores.read_store(spark, f"{out}/anomalies", SCORED)
    assert 0 < anomalies.count() < rows.count() and anomalies.filter("is_anomaly_predicted <> 1").count() == 0
    assert spark.read.parquet(f"{out}/metrics").first()["anomalies"] == anomalies.count()


def test_persisting_as_a_job(spark, tmp_path, sf_dir):
    rows = inputs.readings(spark, sf_dir)
    encode_json(rows).select(inputs.F.col("value").cast("binary")).write.parquet(str(tmp_path / "in"))
    jobs.main(["persist", "--files", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "c"), "--until-caught-up",
               "--series-url", f"file:{tmp_path}/points"])
    assert spark.read.parquet(str(tmp_path / "out" / "processed_data")).count() == rows.count()
    assert sum(len(p.read_text().split("\n")) for p in Path(tmp_path, "points").glob("*.lp")) == rows.count()


def _parsed(*argv):
    return jobs._checked(jobs._arguments(), ["persist", "--out", "o", "--checkpoint", "c", *argv])


@pytest.mark.parametrize(
    "argv",
    [
        [], ["--servers", "s"], ["--topic", "t"], ["--files", "f", "--documents-uri", "mongodb://db"],
        ["--files", "f", "--series-url", "http://db:1"], ["--files", "f", "--trigger-interval", "1 minute", "--until-caught-up"],
    ],
)
def test_missing_arguments_are_named_at_the_start(argv, capsys):
    with pytest.raises(SystemExit):
        _parsed(*argv)
    assert "error" in capsys.readouterr().err


def test_stream_options(spark):
    args = _parsed("--servers", "s", "--topic", "t", "--starting", "earliest", "--documents-uri", "mongodb://db", "--database", "d")
    with mock.patch.object(jobs, "kafka_source") as source:
        jobs._messages(spark, args)
    assert source.call_args.args[1:] == ("s", "t", "earliest", None)
    documents = jobs._sinks(spark, args, scored=True)[:2]
    assert [s.name for s in documents] == ["processed_data", "anomalies"]
    assert all(s.options["idFieldList"] == "sensor_id,timestamp" and s.options["operationType"] == "replace" for s in documents)
    appended = jobs._sinks(spark, _parsed("--files", "f", "--documents-uri", "u", "--database", "d", "--document-id", ""), scored=False)[0]
    assert "idFieldList" not in appended.options


def test_trigger_interval(spark, tmp_path):
    spark.createDataFrame([], "value binary").write.parquet(str(tmp_path / "in"))
    argv = ["persist", "--files", str(tmp_path / "in"), "--out", str(tmp_path / "o"), "--checkpoint", str(tmp_path / "c"), "--trigger-interval", "1 minute"]
    with mock.patch.object(jobs, "run_stream") as run:
        jobs.main(argv)
    assert run.call_args.args[-1] == {"processingTime": "1 minute"}


def test_the_training_command(spark, tmp_path, sf_dir, capsys):
    history = str(tmp_path / "history")
    csv_sink(inputs.readings(spark, sf_dir).select(*LABELLED.names), history)
    with mock.patch.object(jobs, "train_job", wraps=lambda *a, **k: jobs_report(spark)) as called:
        jobs.main(["train", "--history", history, "--model", "m", "--split-key", "timestamp", "--combine-equal"])
    assert called.call_args.args[1:] == (history, "m", "timestamp", None)
    assert called.call_args.kwargs == {"combine_equal": True}


def jobs_report(spark):
    return spark.createDataFrame([(1,)], "rows int")


def test_the_default_layout_does_not_depend_on_the_machine(spark, tmp_path, sf_dir):
    history = str(tmp_path / "history")
    csv_sink(inputs.readings(spark, sf_dir).select(*LABELLED.names), history)
    with mock.patch.object(jobs, "train", wraps=jobs.train) as trained:
        jobs.train_job(spark, history, str(tmp_path / "m"), "timestamp", trees=2, depth=2)
        jobs.train_job(spark, history, str(tmp_path / "m"), "timestamp", trees=2, depth=2, most_rows=100)
    assert [(c.kwargs["key"], c.kwargs["partitions"]) for c in trained.call_args_list] == [("_key", jobs.PARTITIONS)] * 2


def test_most_rows_needs_a_key(spark, tmp_path, capsys):
    with pytest.raises(SystemExit):
        jobs._checked(jobs._arguments(), ["train", "--history", "h", "--model", "m", "--split-key", "", "--most-rows", "5"])
    assert "--split-key" in capsys.readouterr().err


def _sent(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "sensor_id string, temperature float, humidity float, timestamp string")
    encode_json(frame).select(inputs.F.col("value").cast("binary")).write.mode("append").parquet(str(tmp_path / "in"))


def test_watching_the_stream_as_jobs(spark, tmp_path):
    """Readings that arrive out of order, the last of them a heartbeat: hours, profile and stuck sensors."""
    minutes = list(range(0, 180, 2))
    rows = [("a", 7.0 if 40 <= m < 80 else float(m), 50.0, f"2025-07-01T{m // 60:02d}:{m % 60:02d}:00Z") for m in minutes]
    late = [rows[25], rows[22]]
    _sent(spark, tmp_path, [r for r in rows[:30] if r not in late] + [("b", 1.0, 1.0, "no time")])
    run = lambda job, *more: jobs.main([job, "--files", str(tmp_path / "in"), "--out", str(tmp_path / job), "--checkpoint", str(tmp_path / f"{job}.cp"), "--until-caught-up", *more])
    for n in range(2):
        if n:
            _sent(spark, tmp_path, late + rows[30:] + [("beat", 0.0, 0.0, "2025-07-01T09:00:00Z")])
        run("hours", "--delay", "30 minutes")
        run("profile")
        run("stuck", "--delay", "30 minutes")
    hours = spark.read.parquet(str(tmp_path / "hours")).filter("sensor_id = 'a'").orderBy("start").collect()
    assert [(r["start"].hour, r["readings"]) for r in hours] == [(0, 30), (1, 30), (2, 30)]
    kept = {(r["sensor_id"], r["hour"]): r["readings"] for r in kept_profile(spark, str(tmp_path / "profile")).collect()}
    assert kept == {("a", 0): 30, ("a", 1): 30, ("a", 2): 30, ("beat", 9): 1}
    alerts = spark.read.parquet(str(tmp_path / "stuck")).collect()
    assert [(r["sensor_id"], r["start"].minute, r["temperature"]) for r in alerts] == [("a", 40, 7.0)]
    assert spark.read.schema("sensor_id string").parquet(str(tmp_path / "stuck.late")).count() == 0


def test_watching_needs_a_source(capsys):
    for job in ("hours", "profile", "stuck"):
        with pytest.raises(SystemExit):
            jobs._checked(jobs._arguments(), [job, "--out", "o", "--checkpoint", "c"])
    assert "--topic" in capsys.readouterr().err
