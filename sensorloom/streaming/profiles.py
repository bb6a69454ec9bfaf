"""Baselines and daily profiles that batches of a stream keep up to date.

What is stored per sensor and hour is a count, a mean and a sum of squared deviations for each value. Two of
these merge into one without a loss that grows with the values' size, so a batch only adds its own readings to
what the batches before have left, and all readings so far are never read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sensorloom.schemas import FEATURES
from sensorloom.session import written
from sensorloom.sinks.ledger import forget, get_record, numbered, put_record


def moments(df: DataFrame, by: Sequence[str], values: Sequence[str] = FEATURES) -> DataFrame:
    """``readings`` per group, and for each value its count ``_n``, ``_mean`` and squared deviations ``_dev``."""
    figures = [F.count("*").alias("readings")]
    for v in values:
        number = F.col(v).cast("double")
        n = F.count(number)
        figures += [n.alias(f"{v}_n"), F.avg(number).alias(f"{v}_mean"), (F.var_pop(number) * n).alias(f"{v}_dev")]
    return df.groupBy(*by).agg(*figures)


def merged(one: DataFrame, other: DataFrame, by: Sequence[str], values: Sequence[str] = FEATURES) -> DataFrame:
    """The moments of all readings that either table has counted; each has a row per group at most. Null is a group."""
    a, b = (df.select(*[F.col(c).alias(f"_{side}_{c}") for c in df.columns]) for side, df in (("a", one), ("b", other)))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
    both = a.join(b, same, "full_outer")

    def count(name: str):
        return tuple(F.coalesce(f"_{side}_{name}", F.lit(0)) for side in "ab")

    # A group that one table lacks has no readings there, and null in that table's columns.
    groups = [F.when(F.col("_a_readings").isNotNull(), F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in by]
    figures = [sum(count("readings")).alias("readings")]
    for v in values:
        (n, m), (mean, mean_b), (dev, dev_b) = count(f"{v}_n"), *((F.col(f"_a_{v}_{k}"), F.col(f"_b_{v}_{k}")) for k in ("mean", "dev"))
        gap, neither = mean_b - mean, (n > 0) & (m > 0)
        figures += [
            (n + m).alias(f"{v}_n"),
            F.when(neither, mean + gap * m / (n + m)).otherwise(F.when(n > 0, mean).otherwise(mean_b)).alias(f"{v}_mean"),
            F.when(neither, dev + dev_b + gap * gap * n * m / (n + m)).otherwise(F.when(n > 0, dev).otherwise(dev_b)).alias(f"{v}_dev"),
        ]
    return both.select(*groups, *figures)


def coarser(table: DataFrame, by: Sequence[str], values: Sequence[str] = FEATURES) -> DataFrame:
    """The moments of larger groups, as of a sensor from those of its hours; ``table`` should be a stored one.

    Each part's deviations count around the whole group's mean, so nothing large is subtracted from anything large.
    """
    totals = table.groupBy(*by).agg(
        F.sum("readings").alias("readings"), *[F.sum(f"{v}_n").alias(f"{v}_n") for v in values],
        *[(F.sum(F.col(f"{v}_n") * F.col(f"{v}_mean")) / F.nullif(F.sum(f"{v}_n"), F.lit(0))).alias(f"{v}_mean") for v in values],
    )
    parts = table.select(*[F.col(c).alias(f"_{c}") for c in table.columns])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    around = [F.sum(F.col(f"_{v}_dev") + F.col(f"_{v}_n") * F.pow(F.col(f"_{v}_mean") - F.col(f"{v}_mean"), F.lit(2))).alias(f"{v}_dev") for v in values]
    kept = [c for c in totals.columns if c not in by]
    return totals.join(parts, same).groupBy(*by, *kept).agg(*around)


def as_profile(table: DataFrame, values: Sequence[str] = FEATURES) -> DataFrame:
    """Means and sample deviations instead of moments, as :func:`sensorloom.operators.profiles.daily_profile` has them."""
    groups = [c for c in table.columns if c != "readings" and not any(c == f"{v}_{k}" for v in values for k in ("n", "mean", "dev"))]
    figures = []
    for v in values:
        n = F.col(f"{v}_n")
        figures += [F.col(f"{v}_mean"), F.when(n > 1, F.sqrt(F.col(f"{v}_dev") / (n - 1))).alias(f"{v}_std")]
    return table.select(*groups, *figures, "readings")


class ProfileStore:
    """Versions of the moments per sensor and hour, one folder a batch, of which the last two are kept.

    A batch reads the newest version before it and stores its own, with its record last, so a replayed batch counts
    no reading twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def version(self, before: int | None = None) -> int | None:
        done = [n for n in numbered(self.spark, f"{self.path}/records") if before is None or n < before]
        return done[-1] if done else None

    def read(self, version: int) -> DataFrame:
        schema = T.StructType.fromJson(get_record(self.spark, f"{self.path}/records/batch={version}")["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows/batch={version}")

    def write(self, table: DataFrame, version: int) -> None:
        last = self.version(version)
        table.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/rows/batch={version}")
        put_record(self.spark, f"{self.path}/records/batch={version}", {"schema": table.schema.jsonValue()})
        if last is not None:
            for kind in ("records", "rows"):
                forget(self.spark, f"{self.path}/{kind}", last)


def profile_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "sensor_id",
    ts: str = "ts",
    values: Sequence[str] = FEATURES,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep the daily profile of all readings so far at ``path``; see :func:`daily_profile` and :func:`baseline`.

    A busy sensor's readings are combined before they are shuffled, and what is stored has 24 rows per sensor at most
    and one for readings without a time. Readings may arrive in any order. ``path`` belongs to one checkpoint.
    """
    by = [key, "hour"]

    def advance(batch: DataFrame, batch_id: int) -> None:
        store = ProfileStore(batch.sparkSession, path)
        new, last = moments(batch.withColumn("hour", F.hour(ts)), by, values), store.version(batch_id)
        store.write(new if last is None else merged(store.read(last), new, by, values), batch_id)

    writer = readings.writeStream.foreachBatch(advance).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _newest(spark: SparkSession, path: str) -> DataFrame:
    store = ProfileStore(spark, path)
    version = store.version()
    if version is None:
        raise ValueError(f"no batch has been stored at {path}")
    return store.read(version)


def daily_profile(spark: SparkSession, path: str, values: Sequence[str] = FEATURES) -> DataFrame:
    """The profile as of the newest batch, as the batch function of that name would give it over all readings."""
    return as_profile(_newest(spark, path), values)


def baseline(spark: SparkSession, path: str, key: str = "sensor_id", values: Sequence[str] = FEATURES) -> DataFrame:
    """The same per sensor, from the sums per hour."""
    return as_profile(coarser(written(_newest(spark, path), "hours"), [key], values), values)
