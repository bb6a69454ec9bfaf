"""The reading stream: decode, screen, score, and fan every micro-batch out to its stores."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators.codec import decode_json, is_valid
from sensorloom.operators.modeling import score
from sensorloom.schemas import PREDICTED
from sensorloom.sinks.stores import Sink, write_batch
from sensorloom.streaming.eventtime import DELAY, drop_repeats

METRICS = "batch_id bigint, readings bigint, rejected bigint, anomalies bigint"


def read_stream(
    messages: DataFrame, model: PipelineModel | None = None, distinct: Sequence[str] = (), delay: str = DELAY
) -> DataFrame:
    """Messages to readings with a ``valid`` flag and, given a model, a prediction.

    Works on a stream and on a batch alike. Only rejected rows keep their raw ``value``, and their
    prediction is null. On a stream, ``distinct`` names the columns by which a reading that was sent more than
    once is known and stored once; see :func:`sensorloom.streaming.eventtime.drop_repeats`.
    """
    parsed = decode_json(messages, keep=("value",)).withColumn("valid", is_valid())
    readings = parsed.withColumn("value", F.when(~F.col("valid"), F.col("value")))
    if distinct:
        readings = drop_repeats(readings, distinct, delay=delay)
    if model is None:
        return readings
    predicted = F.when(F.col("valid"), F.col("prediction").cast("int"))
    return score(model, readings).withColumn(PREDICTED, predicted).drop("prediction")


def checkpoint_run(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gives a query at its first start and keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def batch_measures(frame: DataFrame) -> list[Column]:
    """A batch's counts: ``readings``, ``rejected`` and ``anomalies``."""
    anomalous = F.col(PREDICTED) == 1 if PREDICTED in frame.columns else F.lit(False)
    return [
        F.count("*").alias("readings"),
        F.count_if(~F.col("valid")).alias("rejected"),
        F.count_if(anomalous).alias("anomalies"),
    ]


def batch_counts(frame: DataFrame) -> DataFrame:
    """All of a batch's counts in one pass."""
    return frame.agg(*batch_measures(frame))


def fan_out(sinks: Sequence[Sink], checkpoint: str, metrics: str | None = None) -> Callable[[DataFrame, int], None]:
    """The function for ``foreachBatch``: persist once, write to all sinks, record the counts.

    The counts are observed on the way of the first folder's write, which also fills the cache, so they cost no
    pass of their own; only a replay that has no folder left to write counts separately. Which stores have
    a batch is recorded below the checkpoint, and a replay writes to the others alone.
    """
    runs: list[str] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not runs:
            runs.append(checkpoint_run(spark, checkpoint))
        frame = batch.persist()
        try:
            if frame.isEmpty():
                return
            # Also without metrics the first folder goes ahead, so that the others find the batch computed.
            observation = Observation(f"batch {batch_id}")
            made = write_batch(frame, batch_id, sinks, runs[0], f"{checkpoint}/stored", (observation, batch_measures(frame)))
            if metrics:
                counts = observation.get if made else batch_counts(frame).first().asDict()
                row = spark.createDataFrame([(batch_id, *[counts[c] for c in ("readings", "rejected", "anomalies")])], METRICS)
                row.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/run={runs[0]}/batch={batch_id}")
        finally:
            frame.unpersist()

    return process


def run_stream(
    messages: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    model: PipelineModel | None = None,
    metrics: str | None = None,
    trigger: Mapping[str, object] | None = None,
    distinct: Sequence[str] = (),
    delay: str = DELAY,
) -> StreamingQuery:
    """Start the stream; without a model it only persists readings.

    With ``distinct``, readings equal in these columns are stored once, if they arrive within ``delay`` of event time.
    ``trigger`` takes the arguments of ``DataStreamWriter.trigger``; by default each batch starts
    as soon as the one before has ended.
    """
    writer = (
        read_stream(messages, model, distinct, delay)
        .writeStream.foreachBatch(fan_out(sinks, checkpoint, metrics))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
