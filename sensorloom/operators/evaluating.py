"""Classification quality from one pass over the predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.schemas import LABEL


def evaluate(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction", anomaly: int = 1
) -> DataFrame:
    """``readings``, ``accuracy``, ``f1_weighted`` (support-weighted over the classes), ``f1_anomaly``.

    On rare anomalies the weighted F1 is high even for a model that never finds one, so the
    anomaly class's own F1 stands next to it. All of them come from the confusion counts: the
    predictions are computed once, and everything after the first aggregate is a few rows. A null
    prediction is a miss; rows without a label are left out.
    """
    confusion = (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted"))
        .agg(F.count("*").alias("n"))
    )
    hit = F.col("actual") == F.col("predicted")
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed")),
    )
    per_class = (
        confusion.select(F.explode(sides).alias("side"), F.when(hit, F.col("n")).otherwise(0).alias("hits"))
        .groupBy("side.class")
        # Both sides of a hit carry its count, so a class's hits arrive here twice.
        .agg(F.sum("side.support").alias("support"), F.sum("side.claimed").alias("claimed"), F.sum("hits").alias("hits2"))
        .withColumn("f1", F.col("hits2") / (F.col("support") + F.col("claimed")))
    )
    total = F.sum("support")
    return per_class.agg(
        F.coalesce(total, F.lit(0)).alias("readings"),
        (F.sum("hits2") / 2 / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1_weighted"),
        F.coalesce(F.max(F.when(F.col("class") == anomaly, F.col("f1"))), F.lit(0.0)).alias("f1_anomaly"),
    )
