"""Merging the folders that micro-batches leave behind.

A stream writes a folder per batch and store, because that is what a replayed batch replaces. Only the
newest batch of a run can be replayed, so all older ones can be merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorloom.session import shared_file_system
from sensorloom.sinks.stores import DAY, by_day

ROWS_PER_FILE = 5_000_000


def _batches(spark: SparkSession, path: str, schema: T.StructType, file_format: str) -> DataFrame:
    layout = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(layout).format(file_format).load(path)


def compact_store(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", keep_last: int = 1, rows_per_file: int = ROWS_PER_FILE,
    dated: str | None = None,
) -> int:
    """Merge each run's batches, but for the ``keep_last`` newest, into the last one merged; return how many went.

    The merged rows are written to a hidden folder first; then the old folders are deleted and the
    new one takes the place of the last. A job that breaks off in between leaves the hidden folder,
    and the next one ends its work. Stop readers meanwhile, or they may miss rows for that moment.
    ``dated`` is the column of a store that is laid out by day; it stays so.
    """
    store, at = shared_file_system(spark, path)
    if not store.exists(at(path)):
        return 0
    runs: dict[str, list[int]] = {}
    for folder in store.listStatus(at(path)):
        run = folder.getPath().getName()
        if run.startswith("run="):
            for batch in store.listStatus(folder.getPath()):
                name = batch.getPath().getName()
                if name.startswith("_merged=") and store.exists(at(f"{path}/{run}/{name}/_SUCCESS")):
                    _replace(store, at, f"{path}/{run}", int(name.removeprefix("_merged=")))
            names = [b.getPath().getName() for b in store.listStatus(folder.getPath())]
            runs[run.removeprefix("run=")] = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    gone = 0
    for run, batches in runs.items():
        closed = batches[: len(batches) - keep_last] if keep_last else batches
        if len(closed) < 2:
            continue
        rows = _batches(spark, path, schema, file_format).filter((F.col("run") == run) & (F.col("batch") <= closed[-1])).select(*schema.names)
        files = 1 + rows.count() // rows_per_file
        writer = (by_day(rows, dated, files).write.partitionBy(DAY) if dated else rows.repartition(files).write).mode("overwrite")
        writer.format(file_format).save(f"{path}/run={run}/_merged={closed[-1]}")
        gone += _replace(store, at, f"{path}/run={run}", closed[-1])
    return gone


def _replace(store, at, folder: str, last: int) -> int:
    """Put the merged rows in place of the batches up to ``last``; return how many folders fewer there are."""
    gone = -1
    for status in store.listStatus(at(folder)):
        name = status.getPath().getName()
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= last:
            store.delete(status.getPath(), True)
            gone += 1
    store.rename(at(f"{folder}/_merged={last}"), at(f"{folder}/batch={last}"))
    return max(gone, 0)
