"""Train/test splits and their row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions.numbers import hash_percent
from sensorloom.schemas import LABEL

# Share of rows to train on, and the seed of the random split.
TRAIN_SHARE = 0.8
SEED = 42


def split_random(
    df: DataFrame, weights: Sequence[float] = (TRAIN_SHARE, 1 - TRAIN_SHARE), seed: int = SEED
) -> list[DataFrame]:
    """Random disjoint parts. The seed fixes them only for one partitioning of the same rows."""
    return df.randomSplit(list(weights), seed)


def with_keyed_part(df: DataFrame, key: str, train_pct: int = 80, part: str = "is_train") -> DataFrame:
    """Mark each row's part by a hash of its key: the same on every layout and every run."""
    return df.withColumn(part, hash_percent(F.col(key)) < train_pct)


def split_keyed(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by a hash of the key. With the sensor as key no sensor is on both sides."""
    train = hash_percent(F.col(key)) < train_pct
    known = F.coalesce(train, F.lit(True))
    return df.filter(known), df.filter(~known)


def train_counts(df: DataFrame, part: str = "is_train", label: str = LABEL) -> DataFrame:
    """Rows per part and label in one pass."""
    return df.groupBy(part, label).agg(F.count("*").alias("readings"))
