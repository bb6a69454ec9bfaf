"""The stores one batch of readings fans out to, and the write that reaches all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sensorloom.functions.times import from_iso
from sensorloom.operators.codec import to_line_protocol
from sensorloom.schemas import PREDICTED, READING, SCORED
from sensorloom.sinks.ledger import forget, get_record, put_record

Rows = Callable[[DataFrame], DataFrame]
#: The partition column of a dated store.
DAY = "day"


@dataclass(frozen=True)
class Sink:
    """One store: which rows and columns of a batch it takes, and where they go.

    With a ``path``, each batch has its own folder there and replaces it when replayed. Without
    one the format's own options say where, and the batch is appended: whether a replay then
    duplicates rows is up to the store.

    ``dated`` names a column of times, by which a folder's rows are laid out: a level of days below the batch,
    and in each file a range of times in order, so that :func:`read_period` opens little else.
    """

    name: str
    rows: Rows
    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    dated: str | None = None


def valid_rows(frame: DataFrame) -> DataFrame:
    """All valid readings: scored if the batch is, plain if not."""
    stored = SCORED.names if PREDICTED in frame.columns else READING.names
    return frame.filter("valid").select(*stored)


def anomalous_rows(frame: DataFrame) -> DataFrame:
    """Anomalies are few: the hint merges them into few files, or none splits if they are many."""
    return valid_rows(frame).filter(F.col(PREDICTED) == 1).hint("rebalance")


def point_lines(frame: DataFrame) -> DataFrame:
    return to_line_protocol(frame.filter("valid"))


def rejected_rows(frame: DataFrame) -> DataFrame:
    """The raw messages that could not be used, as text."""
    return frame.filter(~F.col("valid")).select(F.col("value").cast("string").alias("value")).hint("rebalance")


def processed(path: str, dated: str | None = None) -> Sink:
    return Sink("processed_data", valid_rows, path=path, dated=dated)


def anomalies(path: str, dated: str | None = None) -> Sink:
    return Sink("anomalies", anomalous_rows, path=path, dated=dated)


def series(path: str) -> Sink:
    return Sink("series", point_lines, format="text", path=path)


def rejected(path: str) -> Sink:
    return Sink("rejected", rejected_rows, path=path)


def document_store(name: str, rows: Rows, uri: str, database: str, id_field: str | None = None, **options: str) -> Sink:
    """A collection of a document database through its Spark connector. The collection is called ``name``.

    With ``id_field``, one or more columns (comma-separated) that name a document, a replayed batch replaces
    its own documents; without it they are appended again. ``options`` are the connector's own.
    """
    target = {"connection.uri": uri, "database": database, "collection": name}
    if id_field:
        target |= {"idFieldList": id_field, "operationType": "replace", "upsertDocument": "true"}
    return Sink(name, rows, format="mongodb", options={**target, **options})


def series_store(url: str, org: str, bucket: str, token: str, rejected: str | None = None) -> Sink:
    """A time-series database; see :mod:`sensorloom.sinks.timeseries`, whose source must be registered."""
    target = {"url": url, "org": org, "bucket": bucket, "token": token}
    return Sink("series", point_lines, format="timeseries", options=target | ({"rejected": rejected} if rejected else {}))


def read_store(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    """All batches a path-based sink has stored."""
    return spark.read.schema(schema).format(file_format).load(path).select(*schema.names)


def by_day(rows: DataFrame, dated: str, parts: int | None = None) -> DataFrame:
    """Rows with their ``day``, each file a range of times in order; without a time they have no day.

    Ranges are cut from a sample of the times, so a day with most of the rows is cut too, and small days share a task.
    """
    kind = rows.schema[dated].dataType
    time = from_iso(F.col(dated)) if isinstance(kind, T.StringType) else F.col(dated)
    count = [parts] if parts else []
    return rows.withColumn(DAY, F.to_date(time)).repartitionByRange(*count, DAY, dated).sortWithinPartitions(DAY, dated)


def read_period(spark: SparkSession, path: str, schema: T.StructType, dated: str, since: datetime, until: datetime) -> DataFrame:
    """Rows of a dated store with ``since <= time < until``: folders of other days are not listed as files to read.

    Times are in the session's zone, as the days are. Rows without a time are in no period.
    """
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(path)
    text = isinstance(schema[dated].dataType, T.StringType)
    time = from_iso(F.col(dated)) if text else F.col(dated)
    kind = "timestamp" if text else schema[dated].dataType.simpleString()
    begin, end = (F.lit(t.isoformat(sep=" ")).cast(kind) for t in (since, until))
    days = F.col(DAY).between(F.lit(since.date()), F.lit(until.date()))
    return stored.filter(days & (time >= begin) & (time < end)).select(*schema.names)


def recorded(spark: SparkSession, ledger: str | None, batch_id: int, sink: Sink) -> bool:
    """Whether the ledger says that this store has the batch."""
    return ledger is not None and get_record(spark, f"{ledger}/batch={batch_id}/{sink.name}") is not None


def _write(sink: Sink, frame: DataFrame, run: str, batch_id: int) -> None:
    rows = sink.rows(frame)
    if sink.path and sink.dated:
        rows = by_day(rows, sink.dated)
    writer = rows.write.format(sink.format).options(**sink.options)
    if sink.path:
        if sink.dated:
            writer = writer.partitionBy(DAY)
        writer.mode("overwrite").save(f"{sink.path}/run={run}/batch={batch_id}")
    else:
        named = {"run": run, "batch": str(batch_id)} if sink.format == "timeseries" else {}
        writer.options(**named).mode("append").save()


def write_batch(
    frame: DataFrame,
    batch_id: int,
    sinks: Sequence[Sink],
    run: str,
    ledger: str | None = None,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> bool:
    """Write one batch to every sink; raise at the end if any of them failed.

    Folders are written at the same time. Formats registered from Python are looked up in the calling
    thread's session, so sinks without a path take their turn in that thread meanwhile. One failing
    store does not keep the batch from the others, but the failure is not swallowed either: the batch
    stays uncommitted and is replayed, so that no store misses its rows. ``run`` keeps the folders of
    different checkpoints apart, as each numbers its batches from 0.

    With a ``ledger``, a folder next to the checkpoint, a store that has the batch is recorded there as soon as its
    write ended, and a replay passes it over: only the stores that failed are written again. Records
    are by the sink's name, and of the last two batches. ``observed`` is an observation and its
    metrics, taken over the whole frame on the way of the first folder's write, which then goes ahead of the
    others; returns whether it was made.
    """
    if len({sink.name for sink in sinks}) < len(sinks):
        raise ValueError("two sinks have one name")
    spark, failures = frame.sparkSession, []

    def attempt(sink: Sink, rows: DataFrame = frame) -> Exception | None:
        try:
            _write(sink, rows, run, batch_id)
            if ledger:
                put_record(spark, f"{ledger}/batch={batch_id}/{sink.name}", {"run": run})
        except Exception as failure:
            failure.add_note(f"while writing batch {batch_id} to sink {sink.name}")
            return failure

    left = [sink for sink in sinks if not recorded(spark, ledger, batch_id, sink)]
    folders = [sink for sink in left if sink.path]
    results, made = {}, False
    if observed and folders:
        # The metrics are above every filter of the sink, and none of its rows' shuffles comes before them.
        first = folders.pop(0)
        results[first.name] = attempt(first, frame.observe(observed[0], *observed[1]))
        made = results[first.name] is None
    with ThreadPoolExecutor(max(1, len(folders))) as pool:
        write = inheritable_thread_target(spark)(attempt)
        jobs = {sink.name: pool.submit(write, sink) for sink in folders}
        results |= {sink.name: attempt(sink) for sink in left if not sink.path}
        results |= {name: job.result() for name, job in jobs.items()}
    failures = [results[sink.name] for sink in left if results[sink.name] is not None]
    if failures:
        raise ExceptionGroup(f"batch {batch_id}: {len(failures)} of {len(sinks)} sinks failed", failures)
    if ledger:
        forget(spark, ledger, batch_id - 1)
    return made
