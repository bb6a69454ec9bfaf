"""The event table seen as sensor data."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions.times import to_iso
from sensorloom.operators.codec import encode_json
from sensorloom.schemas import LABEL, READING
from sensorloom.session import scratch
from sensorloom.sources.files import file_stream

RULE = "double(double(temperature) + double(humidity) / 2 > 170)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled readings: the event type is the sensor, the event's value its temperature."""
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        to_iso(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("sensor_id"),
        F.col("value").cast("float").alias("temperature"),
        F.from_json("props", "k float")["k"].alias("humidity"),
        (F.col("value") > 150).cast("int").alias(LABEL),
    )


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the prediction of a fixed rule, which SQL can state too."""
    return readings(spark, sf_dir).withColumn("prediction", F.expr(RULE))


def rule_model() -> PipelineModel:
    """The same rule as a fitted pipeline, for jobs that take a model."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {RULE} AS prediction FROM __THIS__")])


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device per user, reporting a state that repeats and a temperature that jumps."""
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("state"),
        F.col("value").cast("float").alias("temperature"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as JSON messages with numbers of two decimals, next to their event id."""
    as_sent = readings(spark, sf_dir).withColumn("temperature", F.col("temperature").cast("decimal(9,2)").cast("double"))
    return encode_json(as_sent, READING.names, keep=["event_id"])


def binary(encoded: DataFrame) -> DataFrame:
    """As a message topic delivers them."""
    return encoded.withColumn("value", F.col("value").cast("binary"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are unusable.

    Three sensors' are cut off, lack a field, or quote a number. Of the others some have a time that is
    none, or a sensor name that ends in a backslash.
    """
    turn = F.col("event_id") % 11
    whole = readings(spark, sf_dir).withColumns({
        "timestamp": F.when(turn == 3, F.lit("x")).otherwise(F.col("timestamp")),
        "sensor_id": F.when(turn == 5, F.concat("sensor_id", F.lit("\\"))).otherwise(F.col("sensor_id")),
    })
    sensor = F.rtrim(F.col("sensor_id"), F.lit("\\"))
    text = F.to_json(F.struct(*READING.names))
    value = (
        F.when(sensor == "error", F.expr("left(text, length(text) - 1)"))
        .when(sensor == "signup", F.to_json(F.struct(*[c for c in READING.names if c != "humidity"])))
        .when(
            sensor == "purchase",
            F.to_json(F.struct("sensor_id", F.col("temperature").cast("string").alias("temperature"), "humidity", "timestamp")),
        )
        .otherwise(F.col("text"))
    )
    return whole.withColumn("text", text).select("event_id", value.alias("value"))


def damaged_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device log with temperatures that are missing, NaN and infinite, some of them several times in a row."""
    turn, value = F.col("event_id") % 97, F.col("temperature")
    damaged = F.when(turn == 1, F.lit(None)).when(turn == 2, F.lit("NaN")).when(turn == 3, F.lit("Infinity")).when(turn == 4, F.lit("-Infinity"))
    blank = F.when(F.col("device_id") % 7 == 0, F.lit("NaN"))
    return devices(spark, sf_dir).withColumn(
        "temperature", F.when((turn >= 1) & (turn <= 4), damaged.cast("float")).when(blank.isNotNull(), blank.cast("float")).otherwise(F.floor(value / 50).cast("float"))
    )


def staged(
    frame: DataFrame, name: str, batches: int = 4, rows_per_file: int = 1_000_000, files_per_batch: int = 1000
) -> DataFrame:
    """The frame as a stream of files that arrives in ``batches`` micro-batches, or more if they get too large."""
    files = max(batches, frame.count() // rows_per_file)
    path = scratch(frame.sparkSession, name)
    frame.repartition(files).write.parquet(path)
    return file_stream(frame.sparkSession, path, frame.schema, max_files_per_trigger=min(-(-files // batches), files_per_batch))

