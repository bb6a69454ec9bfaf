"""What the operators share: tables, row keys, words, and Arrow-batched work on single texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from sensorloom.operators.ordering import split_busy, spread_join
from sensorloom.session import written

#: A word is a run of anything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts turned into Python objects at a time.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def join_spread(rows: DataFrame, table: DataFrame, key: str, count: str, most: int, salt_by: Sequence[str]) -> DataFrame:
    """``rows`` joined with a stored ``table`` that has a row per key, ``_<key>``, and the ``count`` of the key's rows.

    Rows of keys with more than ``most`` of them, of which there can only be few, are spread over tasks.
    """
    same = F.col(key) == F.col(f"_{key}")
    busy = written(table.filter(F.col(count) > most), "busy")
    if busy.isEmpty():
        return rows.join(table, same)
    busy_rows, other_rows = split_busy(rows, key, busy.select(F.col(f"_{key}").alias("_busy")))
    return spread_join(busy_rows, busy, same, "inner", salt_by).unionByName(other_rows.join(table, same))


def per_text(df: DataFrame, keep: Sequence[str], text: str, fields: Sequence[StructField], function: Callable) -> DataFrame:
    """``keep`` and what ``function`` returns for each text, a tuple of ``fields``; null texts count as empty.

    Texts come in Arrow batches and are taken ``SLICE`` at a time, so a task holds few of them as
    Python objects. Rows stay where they are: no shuffle, and a lost task is just run again.
    """
    schema = StructType([df.schema[c] for c in keep] + list(fields))
    names, types = schema.names, [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = [function(t or "") for t in part.column(len(keep)).to_pylist()]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*made), types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + columns, names)

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)
