"""Global order, exact positions, and cutting ordered histories into bounded pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.session import written

ROWS_PER_TASK = 4_000_000
#: Tables above this size are not broadcast; their rows are copied this often instead.
BROADCAST_BYTES = 64 << 20
SALTS = 64
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within partition below


def chronological(df: DataFrame, ts: str = "timestamp", tie: str = "sensor_id") -> DataFrame:
    """Range-partitioned global sort with a tie-break."""
    return df.orderBy(ts, tie)


def with_position(df: DataFrame, order: Sequence[str], position: str = "position") -> DataFrame:
    """Number all rows from 0 in the given global order, without a one-task window.

    The sorted rows are written once with their place inside their partition. The offsets that
    turn those places into global positions are one row per written partition.
    """
    placed = written(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # bounded by the number of sort partitions
        .select(*df.columns, (F.col("_start") + place).alias(position))
    )


def fits_broadcast(table: DataFrame, budget: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table is small enough to be sent to every executor, by the size of its values as text."""
    row = F.lit(16 * len(table.columns))
    for column in table.columns:
        row = row + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    return (table.agg(F.sum(row.cast("bigint"))).first()[0] or 0) <= budget


def spread_join(
    df: DataFrame, table: DataFrame, on: Column, how: str, salt_by: Sequence[str], budget: int = BROADCAST_BYTES
) -> DataFrame:
    """Join busy keys' rows with a stored ``table`` of few rows per key, without gathering a key in one task.

    A table within the byte budget is broadcast. Of a larger one every row is copied ``SALTS`` times, and
    the rows of ``df`` are dealt over the copies by a hash of ``salt_by``.
    """
    if fits_broadcast(table, budget):
        return df.join(F.broadcast(table), on, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"))
    copies = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, on & (F.col("_salt") == F.col("_copy")), how).drop("_salt", "_copy")


def busy_keys(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """A stored table of the keys with more than ``rows_per_task`` rows: at most ``1 / rows_per_task`` of all rows.

    Reads only the key column and combines before the shuffle. Null counts as a key.
    """
    counted = df.groupBy(key).count().filter(F.col("count") > rows_per_task)
    return written(counted.select(F.col(key).alias("_busy")), "busy")


def split_busy(df: DataFrame, key: str, busy: DataFrame, budget: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(rows of busy keys, all other rows)``."""
    is_busy = F.col(key).eqNullSafe(F.col("_busy"))
    return tuple(spread_join(df, busy, is_busy, how, df.columns, budget) for how in ("left_semi", "left_anti"))


def in_pieces(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    before: int = 0,
    after: int = 0,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Cut the ordered history of busy keys into ``_piece``s that one task can hold.

    Each piece also gets copies of the ``before`` rows ahead of it and the ``after`` rows behind
    it, with ``_own`` false, so that a window over ``(key, _piece)`` sees for every own row what a
    window over the whole history would see within that distance. A key with at most
    ``rows_per_task`` rows is one piece; its rows are not sorted, written or copied here.

    ``df`` is read several times, so it should be a stored table or persisted.
    """
    uncut = {"_piece": F.lit(0).cast("bigint"), "_own": F.lit(True)}
    keys = busy_keys(df, key, rows_per_task)
    if keys.isEmpty():
        return df.withColumns(uncut)

    busy, rest = split_busy(df, key, keys, broadcast_bytes)
    placed = with_position(busy, [key, *order], "_position")

    def piece_of(offset: int):
        return F.expr(f"greatest(_position + {offset}, 0) div {rows_per_task}")

    if before or after:
        pieces = F.explode(F.sequence(piece_of(-after), piece_of(before)))
    else:
        pieces = piece_of(0)
    cut = placed.withColumn("_piece", pieces).withColumn("_own", F.col("_piece") == piece_of(0))
    return rest.withColumns(uncut).unionByName(cut.drop("_position"))
