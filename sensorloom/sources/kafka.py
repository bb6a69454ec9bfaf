"""Kafka topics as a stream of messages, and as a sink for encoded readings.

The connector is a separate package; add it to the session when using these functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of one topic; ``value`` is binary.

    ``starting`` only applies to a query's first start: later ones resume from its checkpoint.
    ``max_offsets_per_trigger`` bounds a micro-batch after downtime.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def kafka_sink(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch frame's ``value`` column to a topic, without message keys."""
    (
        messages.select("value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .save()
    )


def kafka_stream_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """The same for a stream; call ``start()`` on the result."""
    return (
        messages.select("value")
        .writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .option("checkpointLocation", checkpoint)
    )
