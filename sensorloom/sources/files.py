"""CSV histories and file-based message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from sensorloom.schemas import LABELLED


def csv_source(spark: SparkSession, path: str, schema: T.StructType = LABELLED) -> DataFrame:
    """Read CSV files with a header and a fixed schema.

    The header must name the schema's columns in order. Spark's default would bind columns by
    position and read a reordered or foreign file as garbage without an error.
    """
    return spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)


def csv_sink(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = "value binary",
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages that arrive as files: the same ``value`` column a message topic has."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
