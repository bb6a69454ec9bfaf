"""Session defaults and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def session(app_name: str, **settings: str) -> SparkSession:
    """A session in UTC; timestamps are exchanged as ISO text with a literal ``Z``."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``, or else below the warehouse.

    Every executor must be able to read what another one wrote there; both settings name shared storage.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving every scratch path made inside.

    For jobs and micro-batches, whose results are stored before the scope ends. A DataFrame that
    is still to be read must not come from a closed scope.
    """
    opened: list[str] = []
    token = _scope.set(opened)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in opened:
            store, at = shared_file_system(spark, path)
            store.delete(at(path), True)


def shared_file_system(spark: SparkSession, path: str):
    """The file system of ``path`` as Spark sees it, and the function that makes its paths.

    PySpark has no public call to delete or rename what Spark has written.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a file read, and every later use sees the
    same rows even where ``df`` itself is not deterministic.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
