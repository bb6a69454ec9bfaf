"""Vectors of whole numbers: which rows have one, and searches of queries against rows block by block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.session import written

SCALE = 256
#: A score beyond a long counts as the largest or least of these.
LONGEST = (1 << 63) - 1
#: Rows of a block: at least, at most, and as many blocks as a table of rows between should have.
LEAST_BLOCK, MOST_BLOCK, BLOCKS = 1024, 16_384, 64
#: Queries that meet a block at a time.
QUERY_BLOCK = 2048
MOST_PARTITIONS = 20_000


def whole_vectors(df: DataFrame, *keep: Column, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """A stored row per vector: ``row`` (its own number), ``vec_id``, ``vector`` and ``keep``; components are ``floor(scale * x)``.

    Rows whose vector is null or holds a null, NaN or infinite component are left out. Components beyond a
    long count as the nearest one. ``row`` tells repeated rows apart.
    """
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))

    full = F.coalesce(F.forall(vector, finite), F.lit(False))
    numbers = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    rows = df.filter(full).select(F.col("vec_id").cast("bigint").alias("vec_id"), numbers.alias("vector"), *keep)
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """The vectors as rows of a matrix; shorter ones are filled up with zeros, to ``width`` columns at least."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), max([width, *sizes])), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def id_order(ids: pa.ChunkedArray) -> np.ndarray:
    """Positions in the order of the ids, null last."""
    return np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))


def first_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, highest first and ties in the order they stand in."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def bucket(count: int, by: str = "row") -> Column:
    """One of ``count`` buckets of about equal size."""
    return F.pmod(F.xxhash64(by), F.lit(count)).cast("int")


def block_rows(rows: int) -> int:
    return min(max(LEAST_BLOCK, -(-rows // BLOCKS)), MOST_BLOCK)


def against_all(rows: DataFrame, n_rows: int, queries: DataFrame, n_queries: int, meet: Callable, schema: str) -> DataFrame:
    """What ``meet(rows, queries)``, on Arrow tables, returns for every block of rows and block of queries.

    Blocks are dealt by a hash of ``row``, so equal vectors and labels don't gather in one. Rows are
    copied once for each block of queries, queries once for each block of rows, and one task never holds
    more than two blocks.
    """
    blocks, groups = max(1, -(-n_rows // block_rows(n_rows))), max(1, -(-n_queries // QUERY_BLOCK))
    partitions = min(blocks * groups, MOST_PARTITIONS)

    def dealt(df: DataFrame, own: str, count: int, other: str, copies: int) -> DataFrame:
        placed = df.withColumn(own, bucket(count)).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        return placed.repartition(partitions, "_block", "_group")

    left = dealt(rows, "_block", blocks, "_group", groups).groupBy("_block", "_group")
    right = dealt(queries, "_group", groups, "_block", blocks).groupBy("_block", "_group")
    return left.cogroup(right).applyInArrow(meet, schema)
