"""What stands in the stores after batches are replayed, in part or as a whole."""

import json
from pathlib import Path
from unittest import mock

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorloom.plans import inputs
from sensorloom.schemas import LINE, READING
from sensorloom.sinks import stores, timeseries
from sensorloom.sources.files import file_stream
from sensorloom.streaming.fanout import run_stream

NOW = {"availableNow": True}


@pytest.fixture
def points(spark, tmp_path):
    """Write lines 0 to ``rows`` as a batch of so many partitions; what stands in the folder afterwards."""
    spark.dataSource.register(timeseries.TimeSeriesDataSource)
    folder = tmp_path / "points"

    def write(rows, partitions, batch=0, run="r", points="100"):
        frame = spark.range(rows).select(F.concat(F.lit(f"m b={batch}i,v="), F.col("id").cast("string"), F.lit("i")).alias("line")).repartition(partitions)
        options = {"url": f"file:{folder}", "points": points, "run": run, "batch": str(batch)}
        frame.write.format("timeseries").options(**options).mode("append").save()
        return sorted(line for p in folder.glob("*.lp") for line in p.read_text().split("\n"))

    write.folder = folder
    return write


def _lines(rows, batch=0):
    return sorted(f"m b={batch}i,v={n}i" for n in range(rows))


def test_a_batch_replayed_in_fewer_partitions_stands_once(points):
    assert points(1000, 8) == _lines(1000)
    assert points(1000, 2) == _lines(1000)
    assert points(1000, 5) == _lines(1000)
    assert points(300, 3, batch=1) == sorted(_lines(1000) + _lines(300, 1))
    assert points(1000, 1) == sorted(_lines(1000) + _lines(300, 1))
    assert points(0, 2, batch=1) == _lines(1000)  # it has no rows any more
    assert not list(Path(f"{points.folder}.commits", "staging").iterdir())


def test_runs_and_batches_with_similar_names_are_apart(points):
    points(10, 2, batch=1)
    assert len(points(10, 2, batch=11)) == 20
    assert len(points(10, 2, batch=1, run="r-1")) == 30
    assert len(points(10, 1, batch=1)) == 30


@pytest.mark.parametrize("fails_at", range(6))
def test_a_commit_that_broke_off_is_put_right(points, fails_at):
    """Whatever step it breaks off at, no line stands twice, and the replay ends with each line once."""
    points(40, 4, points="5")
    folder = timeseries._Folder(f"file:{points.folder}", "r-0")
    staged = []
    for part in range(2):
        names = [f"r-0-{part:05d}-{n:05d}.lp" for n in range(2)]
        for n, name in enumerate(names):
            timeseries.put(folder.store, f"{folder.staging}/{part}", name, _lines(40)[20 * part + 10 * n :][:10])
        staged.append(timeseries.Written("r-0", str(part), names, []))
    steps, move = iter(range(100)), folder.store.move

    class Breaks:
        def __getattr__(self, name):
            return getattr(store, name)

        def move(self, *args):
            if next(steps) == fails_at:
                raise OSError("lost")
            return move(*args)

    store, folder.store = folder.store, Breaks()
    with pytest.raises(OSError, match="lost"):
        folder.commit(staged)
    standing = [line for p in points.folder.glob("*.lp") for line in p.read_text().split("\n")]
    assert len(standing) == len(set(standing))
    assert points(40, 3) == _lines(40)


def test_a_failed_write_leaves_nothing(spark, points):
    points(20, 2)
    bad = spark.range(20).repartition(2).select(F.when(F.col("id") == 7, F.raise_error(F.lit("bad row"))).otherwise("m v=1i").alias("line"))
    with pytest.raises(Exception, match="bad row"):
        bad.write.format("timeseries").options(url=f"file:{points.folder}", run="r", batch="5").mode("append").save()
    assert points(0, 1, batch=6) == _lines(20)
    assert not list(Path(f"{points.folder}.commits", "staging").iterdir())


def test_refused_lines_of_a_replayed_batch_are_replaced(tmp_path):
    options = {"url": "http://db:1", "bucket": "b", "rejected": f"{tmp_path}/refused", "run": "r", "batch": "7"}
    writer = timeseries._BatchWriter(options)
    for parts in (["1", "2", "3"], ["9"]):
        messages = []
        for n, part in enumerate(parts):
            name = f"r-7-{n:05d}-00000.lp"
            timeseries.put(*timeseries.opened(options["rejected"]), name, [part])
            messages.append(timeseries.Written("r-7", str(n), [], [name]))
        writer.commit(messages)
    assert {p.name: p.read_text() for p in Path(tmp_path, "refused").glob("*.lp")} == {"r-7-00000-00000.lp": "9"}


# Which stores have a batch


def _message(n):
    return json.dumps({"sensor_id": f"s{n % 3}", "temperature": 20.0 + n, "humidity": 50.0, "timestamp": f"2025-07-01T00:00:{n % 60:02d}Z"})


class Counting:
    """Sinks that count how often they are written, of which some fail so many times."""

    def __init__(self, tmp_path):
        self.tmp_path, self.writes, self.failing = tmp_path, {}, {}

    def sink(self, name, rows=stores.valid_rows, **kind):
        def counted(frame):
            self.writes[name] = self.writes.get(name, 0) + 1
            if self.failing.get(name, 0):
                self.failing[name] -= 1
                raise ValueError(f"{name} is down")
            return rows(frame)

        return stores.Sink(name, counted, **({"path": str(self.tmp_path / name)} | kind))


def _run(spark, tmp_path, sinks, **settings):
    stream = file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    run_stream(stream, sinks, str(tmp_path / "cp"), inputs.rule_model(), trigger=NOW, **settings).awaitTermination()


def _arrive(spark, tmp_path, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary"))
    frame.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))


def test_a_replay_writes_only_the_stores_that_failed(spark, tmp_path):
    counting = Counting(tmp_path)
    appended = {"path": None, "format": "parquet", "options": {"path": str(tmp_path / "appended")}}
    sinks = [counting.sink("one"), counting.sink("two"), counting.sink("three"), counting.sink("appended", **appended)]
    _arrive(spark, tmp_path, [_message(n) for n in range(9)])
    counting.failing = {"two": 2}
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="1 of 4 sinks failed"):
            _run(spark, tmp_path, sinks, metrics=str(tmp_path / "metrics"))
    _run(spark, tmp_path, sinks, metrics=str(tmp_path / "metrics"))
    assert counting.writes == {"one": 1, "two": 3, "three": 1, "appended": 1}
    for name in ("one", "two", "three"):
        assert stores.read_store(spark, str(tmp_path / name), READING).count() == 9
    assert spark.read.parquet(str(tmp_path / "appended")).count() == 9  # a store that only appends has each row once too
    assert [r["readings"] for r in spark.read.parquet(str(tmp_path / "metrics")).collect()] == [9]
    _arrive(spark, tmp_path, [_message(n) for n in range(4)])
    _run(spark, tmp_path, sinks)
    assert counting.writes == {"one": 2, "two": 4, "three": 2, "appended": 2}


@pytest.mark.parametrize("down", ["one", "two"])
def test_counts_are_right_whichever_store_failed(spark, tmp_path, down):
    """The first store's write carries the observation; where it fails or is passed over, the counts come otherwise."""
    counting = Counting(tmp_path)
    sinks = [counting.sink("one"), counting.sink("two")]
    _arrive(spark, tmp_path, [_message(n) for n in range(30)] + ["bad"] * 3)
    counting.failing = {down: 1}
    with pytest.raises(StreamingQueryException):
        _run(spark, tmp_path, sinks, metrics=str(tmp_path / "metrics"))
    _run(spark, tmp_path, sinks, metrics=str(tmp_path / "metrics"))
    row = spark.read.parquet(str(tmp_path / "metrics")).first()
    anomalies = stores.read_store(spark, str(tmp_path / "one"), stores.SCORED).filter("is_anomaly_predicted = 1").count()
    assert (row["readings"], row["rejected"], row["anomalies"]) == (33, 3, anomalies)


def test_counts_take_no_job_of_their_own(spark, tmp_path):
    """The plan of the first store's write has the counts in it; no aggregate runs beside the writes."""
    _arrive(spark, tmp_path, [_message(n) for n in range(10)])
    plans = []
    written = stores._write

    def kept(sink, frame, run, batch_id):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return written(sink, frame, run, batch_id)

    with mock.patch.object(stores, "_write", kept), mock.patch("sensorloom.streaming.fanout.batch_counts") as counted:
        _run(spark, tmp_path, [stores.processed(str(tmp_path / "a")), stores.rejected(str(tmp_path / "r"))], metrics=str(tmp_path / "metrics"))
    assert not counted.called
    assert ["CollectMetrics" in plan for plan in plans] == [True, False]
    assert spark.read.parquet(str(tmp_path / "metrics")).first()["readings"] == 10


def test_sinks_need_names_of_their_own(spark, tmp_path):
    with pytest.raises(ValueError, match="one name"):
        stores.write_batch(spark.range(1), 0, [stores.processed("a"), stores.processed("b")], "r")


def test_lines_read_from_the_folder(spark, points):
    points(50, 3)
    assert spark.read.schema(LINE).text(str(points.folder)).count() == 50
