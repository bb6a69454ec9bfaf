"""The registered queries, each over the whole event table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions.numbers import round_reading
from sensorloom.operators import codec, detecting, modeling, profiles, splitting
from sensorloom.operators.evaluating import evaluate
from sensorloom.operators.ordering import with_position
from sensorloom.plans import inputs
from sensorloom.schemas import FEATURES, LABEL, LABELLED, LINE, PREDICTED, READING, SCORED
from sensorloom.session import scratch, written
from sensorloom.sinks import stores
from sensorloom.sinks.compaction import compact_store
from sensorloom.sinks.timeseries import TimeSeriesDataSource
from sensorloom.sources.files import csv_sink, csv_source, file_stream
from sensorloom.streaming.eventtime import rollup_stream
from sensorloom.streaming.fanout import run_stream
from sensorloom.streaming.profiles import baseline as kept_baseline, daily_profile as kept_profile, profile_stream
from sensorloom.streaming.stuck import stuck_runs_stream

NOW = {"availableNow": True}
#: Rows that a task trains on or scores.
ROWS_EACH = 100_000
#: How training rows are laid out: by event id, in this many partitions on every machine, or more for many rows.
LAYOUT = {"key": "event_id", "partitions": 16, "rows_each": ROWS_EACH}


def _rounded(df: DataFrame, columns: Sequence[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _moment_names(values: Sequence[str]) -> list[str]:
    return [f"{v}_{m}" for v in values for m in ("mean", "std")]


# Messages and files


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.messages(spark, sf_dir)


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = inputs.binary(inputs.messages(spark, sf_dir))
    return codec.decode_json(received, keep=["event_id"])


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    csv_sink(inputs.readings(spark, sf_dir).select(*LABELLED.names), path)
    return csv_source(spark, path)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = codec.decode_json(inputs.damaged_messages(spark, sf_dir), keep=["event_id"])
    return parsed.select("event_id", "sensor_id", codec.is_valid().alias("valid"))


def ts_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.to_line_protocol(inputs.readings(spark, sf_dir), keep=["event_id"])


# Columns


def round_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.readings(spark, sf_dir).select(
        "event_id",
        round_reading(F.col("temperature").cast("double")).alias("temperature"),
        round_reading(F.col("humidity").cast("double") / 8).alias("humidity_eighth"),
    )


def score_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.scored_columns(inputs.ruled(spark, sf_dir), keep=["event_id"])


def ts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.latest_per_point(inputs.readings(spark, sf_dir), ["sensor_id", "timestamp"], "event_id", FEATURES)


def chrono_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_position(inputs.readings(spark, sf_dir).select("event_id", "ts", "sensor_id"), ["ts", "event_id"])
    return placed.select("event_id", "sensor_id", (F.col("position") + 1).alias("chrono_rank"))


# Features, splits and metrics


def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiles.feature_stats(inputs.readings(spark, sf_dir)), _moment_names(FEATURES))


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    assembled = modeling.assemble(inputs.readings(spark, sf_dir))
    return modeling.vector_columns(assembled, modeling.UNSCALED, FEATURES, ["event_id"])


def scale_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = modeling.standardise(inputs.readings(spark, sf_dir))
    return _rounded(modeling.vector_columns(scaled, modeling.SCALED, FEATURES, ["event_id"]), FEATURES)


def split_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.with_keyed_part(inputs.readings(spark, sf_dir), "event_id").select("event_id", "is_train")


def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the two parts each reading is in, and whether the first has four fifths of all, give or take four deviations."""
    train, test = splitting.split_random(inputs.readings(spark, sf_dir).select("event_id"))
    both = train.withColumn("first", F.lit(1)).unionAll(test.withColumn("first", F.lit(0)))
    share, rows = both.agg(F.avg("first"), F.count("*")).first()
    near = rows == 0 or abs(share - 0.8) <= 4 * (0.8 * 0.2 / rows) ** 0.5
    parts = both.groupBy("event_id").agg(F.count("*").alias("parts"))
    return parts.withColumn("share_as_asked", F.lit(near))


def train_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.train_counts(splitting.with_keyed_part(inputs.readings(spark, sf_dir), "event_id"))


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate(inputs.ruled(spark, sf_dir)), ["accuracy", "f1_weighted", "f1_anomaly"])


# The model


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest, trained on one part of the readings and scoring the other: who was scored, and whether well."""
    train, test = splitting.split_keyed(inputs.readings(spark, sf_dir), "event_id")
    scored = modeling.score(modeling.train(train, **LAYOUT), modeling.spread(test, "event_id", ROWS_EACH))
    scored = written(scored.select("event_id", LABEL, "prediction"), "scored")
    quality = evaluate(scored).first()
    good = quality["accuracy"] >= 0.975 and quality["f1_anomaly"] >= 0.8
    return scored.select("event_id", LABEL, F.col("prediction").isNotNull().alias("scored"), F.lit(good).alias("good"))


def holdout_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the forest does well on the readings it was not trained on."""
    train, test = splitting.split_keyed(inputs.readings(spark, sf_dir), "event_id")
    return evaluate(modeling.score(modeling.train(train, **LAYOUT), test)).select(
        "readings", (F.col("accuracy") >= 0.975).alias("accurate"), (F.col("f1_anomaly") >= 0.8).alias("finds_anomalies")
    )


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each reading's prediction survives saving and loading the model. An invariant, no check of the prediction."""
    rows = inputs.readings(spark, sf_dir)
    model = modeling.train(rows, **LAYOUT)
    path = scratch(spark, "model")
    modeling.save_model(model, path)
    before = modeling.score(model, modeling.spread(rows, "event_id", ROWS_EACH)).withColumnRenamed("prediction", "before")
    after = modeling.score(modeling.load_model(spark, path), before)
    return after.select("event_id", (F.col("before") == F.col("prediction")).alias("same"))


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings scored on a stream, and whether scoring them in batch gives the same; an invariant like the one above."""
    rows = inputs.readings(spark, sf_dir)
    model = modeling.train(rows, **LAYOUT)
    arriving = inputs.staged(inputs.binary(inputs.messages(spark, sf_dir)), "messages", rows_per_file=ROWS_EACH)
    decoded = codec.decode_json(arriving, keep=["event_id"])
    path = scratch(spark, "scored")
    scored = codec.scored_columns(modeling.score(model, decoded), keep=["event_id"])
    scored.writeStream.option("checkpointLocation", scratch(spark, "checkpoint")).trigger(**NOW).start(path).awaitTermination()
    live = spark.read.schema(scored.schema).parquet(path)
    again = modeling.score(model, modeling.spread(live, "event_id", ROWS_EACH))
    return again.select(
        "event_id", *[c for c in SCORED.names if c != PREDICTED], (F.col(PREDICTED) == F.col("prediction")).alias("same")
    )


# Stores and streams


def _written_batch(spark: SparkSession, sf_dir: str, sink: Callable[[str], stores.Sink]) -> DataFrame:
    frame = inputs.ruled(spark, sf_dir).withColumn("valid", codec.is_valid())
    frame = frame.withColumn(PREDICTED, F.col("prediction").cast("int"))
    path = scratch(spark, "store")
    stores.write_batch(frame, 0, [sink(path)], "batch")
    return stores.read_store(spark, path, SCORED)


def sink_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_batch(spark, sf_dir, stores.processed)


def sink_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_batch(spark, sf_dir, stores.anomalies)


def _streamed(arriving: DataFrame, sinks: Sequence[stores.Sink], model=None, metrics: str | None = None) -> None:
    checkpoint = scratch(arriving.sparkSession, "checkpoint")
    run_stream(arriving.select("value"), sinks, checkpoint, model, metrics, NOW).awaitTermination()


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.staged(inputs.binary(inputs.messages(spark, sf_dir).select("value")), "messages")


def persist_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream without a model, as the document store holds it."""
    path = scratch(spark, "store")
    _streamed(_arriving(spark, sf_dir), [stores.processed(path), stores.series(scratch(spark, "series"))])
    return stores.read_store(spark, path, READING)


def sink_fanout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored stream, as the two document stores hold it."""
    every, anomalous, series, bad = (scratch(spark, name) for name in ("all", "anomalies", "series", "rejected"))
    sinks = [stores.series(series), stores.processed(every), stores.anomalies(anomalous), stores.rejected(bad)]
    _streamed(_arriving(spark, sf_dir), sinks, inputs.rule_model())
    all_rows = stores.read_store(spark, every, SCORED).withColumn("store", F.lit("processed_data"))
    return all_rows.unionByName(stores.read_store(spark, anomalous, SCORED).withColumn("store", F.lit("anomalies")))


def ts_sink_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream as the time-series sink delivers it, to files for a bulk import."""
    spark.dataSource.register(TimeSeriesDataSource)
    path = scratch(spark, "series")
    _streamed(_arriving(spark, sf_dir), [stores.series_store(path, "", "", "")])
    return spark.read.schema(LINE).text(path)


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts the micro-batches reported, on a stream with bad messages."""
    arriving = inputs.staged(inputs.binary(inputs.damaged_messages(spark, sf_dir).select("value")), "messages")
    metrics = scratch(spark, "metrics")
    _streamed(arriving, [stores.processed(scratch(spark, "store"))], inputs.rule_model(), metrics)
    counts = ("readings", "rejected", "anomalies")
    return spark.read.parquet(metrics).agg(*[F.sum(c).alias(c) for c in counts])


# Detectors


def sensor_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiles.baseline(inputs.readings(spark, sf_dir)), _moment_names(FEATURES))


def daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiles.daily_profile(inputs.readings(spark, sf_dir)), _moment_names(FEATURES))


def profile_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.readings(spark, sf_dir)
    profile = written(profiles.daily_profile(rows), "profile")
    gaps = profiles.residual(rows.select("event_id", "sensor_id", "ts", *FEATURES), profile)
    names = [f"{v}_residual" for v in FEATURES]
    return _rounded(gaps.select("event_id", "sensor_id", "hour", *names), names)


def spike_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.readings(spark, sf_dir).select("event_id", "ts", "sensor_id", "temperature")
    return detecting.spikes(rows, n=20, threshold=200).select("event_id", "sensor_id", "temperature")


def spikes_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spikes in a log with missing, NaN and infinite temperatures."""
    rows = inputs.damaged_devices(spark, sf_dir)
    found = detecting.spikes(rows, key="device_id", n=5, threshold=2)
    return found.select("event_id", "device_id", "temperature")


def stuck_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stuck temperatures in the same log."""
    rows = inputs.damaged_devices(spark, sf_dir)
    return detecting.stuck_runs(rows, key="device_id", min_readings=3)


def labels_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of anomaly in the same log."""
    rows = inputs.damaged_devices(spark, sf_dir)
    labelled = detecting.label_anomalies(rows, key="device_id", n=5, threshold=2, min_readings=3)
    return labelled.select("event_id", "device_id", "is_spike", "is_stuck", "is_anomaly")


def stuck_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detecting.stuck_runs(inputs.devices(spark, sf_dir), key="device_id", value="state", min_readings=3)


def anomaly_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = detecting.label_anomalies(
        inputs.devices(spark, sf_dir), key="device_id", repeated="state", n=10, threshold=150, min_readings=3
    )
    return labelled.select("event_id", "device_id", "is_spike", "is_stuck", "is_anomaly")


def stuck_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four periods of the device log arrive one after the other; the stream is restarted for each."""
    log = inputs.devices(spark, sf_dir)
    columns = ["event_id", "ts", "device_id", "state"]
    arrivals, alerts, checkpoint = (scratch(spark, name) for name in ("arrivals", "alerts", "checkpoint"))
    quarters = F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75])
    cuts = [F.timestamp_micros(F.lit(c)).cast("timestamp_ntz") for c in log.agg(quarters).first()[0]]
    # Without a time a reading sorts first, as in the batch detector; so it arrives in the first period.
    since = [F.lit(True), *[F.col("ts") >= c for c in cuts]]
    until = [*[F.col("ts").isNull() | (F.col("ts") < c) for c in cuts], F.lit(True)]
    for n, (begun, over) in enumerate(zip(since, until)):
        period = log.select(*columns).filter(begun & over if n == 0 else F.col("ts").isNotNull() & begun & over)
        period.write.mode("append").parquet(arrivals)
        live = spark.readStream.schema(log.select(*columns).schema).parquet(arrivals)
        stuck_runs_stream(
            live, alerts, checkpoint, key="device_id", value="state", min_readings=3, trigger=NOW
        ).awaitTermination()
    return spark.read.parquet(alerts).select("device_id", "start", "state")


# Event time


def _cuts(rows: DataFrame, time, parts: int = 4) -> list:
    """Times that part the rows into periods of about equal size."""
    found = rows.agg(F.percentile_approx(F.unix_micros(time.cast("timestamp")), [n / parts for n in range(1, parts)])).first()[0]
    return [F.timestamp_micros(F.lit(c)).cast("timestamp_ntz") for c in found or []]


def _periods(rows: DataFrame, time) -> list[DataFrame]:
    """The rows in periods that arrive one after the other; rows without a time come first."""
    cuts = _cuts(rows, time)
    period = F.size(F.filter(F.array(*cuts), lambda c: time >= c)) if cuts else F.lit(0)
    period = F.coalesce(period, F.lit(0))
    return [rows.filter(period == n) for n in range(len(cuts) + 1)]


def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures per sensor and hour; four periods arrive one after the other, each after a restart."""
    rows = inputs.readings(spark, sf_dir).select("ts", "sensor_id", *FEATURES)
    arrivals, path, checkpoint = (scratch(spark, name) for name in ("arrivals", "hours", "checkpoint"))
    for period in _periods(rows, F.col("ts")):
        period.write.mode("append").parquet(arrivals)
        live = spark.readStream.schema(rows.schema).parquet(arrivals)
        last = rollup_stream(live, path, checkpoint, ts="ts", trigger=NOW)
        last.awaitTermination()
    names = ["sensor_id string", "start timestamp_ntz", "end timestamp_ntz", "readings bigint"]
    figures = [f"{v}_{m}" for v in FEATURES for m in ("mean", "std", "min", "max")]
    hours = spark.read.schema(", ".join([*names, *[f"{f} double" for f in figures]])).parquet(path)
    return _rounded(hours.drop("day"), figures)


def distinct_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream without a model where messages arrive again: some twice in a batch, some once more after a restart."""
    rows = inputs.readings(spark, sf_dir).select("event_id", "ts")
    sent = inputs.binary(inputs.messages(spark, sf_dir)).join(rows, "event_id")
    arrivals, path, checkpoint = (scratch(spark, name) for name in ("arrivals", "store", "checkpoint"))
    before = None
    for period in _periods(sent, F.col("ts")):
        again = period.filter("event_id % 3 = 0")
        if before is not None:
            again = again.unionByName(before.filter("event_id % 4 = 1"))
        before = period
        arriving = period.unionByName(again).select("value")
        arriving.write.mode("append").parquet(arrivals)
        run_stream(
            file_stream(spark, arrivals, arriving.schema), [stores.processed(path)], checkpoint, trigger=NOW,
            distinct=READING.names, delay="60 days",
        ).awaitTermination()
    return stores.read_store(spark, path, READING)


def stuck_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stuck sensors where every reading arrives up to six hours late; four periods of arrival, then a heartbeat."""
    log = inputs.devices(spark, sf_dir).select("event_id", "ts", "device_id", "state")
    late = F.make_dt_interval(secs=F.pmod(F.xxhash64("event_id"), F.lit(6 * 3600)).cast("decimal(18,6)"))
    log = log.withColumn("_arrives", F.col("ts") + late)
    arrivals, alerts, checkpoint = (scratch(spark, name) for name in ("arrivals", "alerts", "checkpoint"))
    beat = log.agg(F.max("ts").alias("ts")).select(
        F.lit(None).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("interval 1 day")).alias("ts"),
        F.lit(None).cast(log.schema["device_id"].dataType).alias("device_id"), F.lit("heartbeat").alias("state"),
    )
    for period in [*(p.drop("_arrives") for p in _periods(log, F.col("_arrives"))), beat]:
        period.write.mode("append").parquet(arrivals)
        live = spark.readStream.schema(period.schema).parquet(arrivals)
        stuck_runs_stream(
            live, alerts, checkpoint, key="device_id", value="state", min_readings=3, trigger=NOW, delay="6 hours"
        ).awaitTermination()
    return spark.read.parquet(alerts).select("device_id", "start", "state")


def _kept_profile(spark: SparkSession, sf_dir: str) -> str:
    """Where four batches of the log, the second half of it before the first, have kept the profile; each after a restart."""
    rows = inputs.readings(spark, sf_dir).select("ts", "sensor_id", *FEATURES)
    arrivals, path, checkpoint = (scratch(spark, name) for name in ("arrivals", "profile", "checkpoint"))
    periods = _periods(rows, F.col("ts"))
    for period in periods[2:] + periods[:2]:
        period.write.mode("append").parquet(arrivals)
        profile_stream(spark.readStream.schema(rows.schema).parquet(arrivals), path, checkpoint, trigger=NOW).awaitTermination()
    return path


def profile_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily profile that a stream keeps up to date, batch by batch."""
    return _rounded(kept_profile(spark, _kept_profile(spark, sf_dir)), _moment_names(FEATURES))


def baseline_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline from what the stream keeps."""
    return _rounded(kept_baseline(spark, _kept_profile(spark, sf_dir)), _moment_names(FEATURES))


def dated_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of readings from a store that a stream has laid out by day, after its older batches were merged."""
    path = scratch(spark, "store")
    _streamed(_arriving(spark, sf_dir), [stores.processed(path, dated="timestamp")])
    compact_store(spark, path, READING, dated="timestamp")
    return stores.read_period(spark, path, READING, "timestamp", datetime(2024, 1, 8, 12), datetime(2024, 1, 18))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_encode": json_encode,
    "json_parse": json_parse,
    "csv_scan": csv_scan,
    "quarantine": quarantine,
    "ts_line_protocol": ts_line_protocol,
    "round_reading": round_readings,
    "score_projection": score_projection,
    "ts_upsert": ts_upsert,
    "chrono_order": chrono_order,
    "feature_stats": feature_stats,
    "assemble_features": assemble_features,
    "scale_features": scale_features,
    "split_keyed": split_keyed,
    "split_random": split_random,
    "train_counts": train_counts,
    "eval_metrics": eval_metrics,
    "score_batch": score_batch,
    "holdout_quality": holdout_quality,
    "model_roundtrip": model_roundtrip,
    "score_stream": score_stream,
    "sink_processed": sink_processed,
    "sink_anomalies": sink_anomalies,
    "persist_stream": persist_stream,
    "sink_fanout_stream": sink_fanout_stream,
    "ts_sink_stream": ts_sink_stream,
    "batch_metrics": batch_metrics,
    "sensor_baseline": sensor_baseline,
    "daily_profile": daily_profile,
    "profile_residual": profile_residual,
    "spike_detect": spike_detect,
    "stuck_runs": stuck_runs,
    "spikes_damaged": spikes_damaged,
    "stuck_damaged": stuck_damaged,
    "labels_damaged": labels_damaged,
    "anomaly_labels": anomaly_labels,
    "stuck_stream": stuck_stream,
    "hourly_rollup": hourly_rollup,
    "distinct_stream": distinct_stream,
    "stuck_unordered": stuck_unordered,
    "dated_store": dated_store,
    "profile_kept": profile_kept,
    "baseline_kept": baseline_kept,
}
