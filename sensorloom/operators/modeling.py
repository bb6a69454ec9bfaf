"""The anomaly classifier: features, pipeline, training, scoring and storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions.numbers import any_of, is_missing
from sensorloom.schemas import FEATURES, LABEL

# Size and seed of the forest, and the names of the feature vectors.
TREES = 100
DEPTH = 10
SEED = 42
#: Of equal readings combined into weighted rows, into how many rows at most.
COPIES = 16
UNSCALED = "features_unscaled"
SCALED = "features"


def assemble(df: DataFrame, features: Sequence[str] = FEATURES, out: str = UNSCALED) -> DataFrame:
    """Add the features as one vector; a null or NaN feature is an error."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol=UNSCALED, outputCol=SCALED, withMean=True, withStd=True)


def standardise(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add the features' vector and its standardised form; a constant feature becomes 0.

    Only the means and deviations pass through the driver: one number per feature.
    """
    assembled = assemble(df, features)
    return _scaler().fit(assembled.select(UNSCALED)).transform(assembled)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """A vector's elements as columns, so that SQL can read them."""
    elements = vector_to_array(F.col(vector))
    return df.select(*keep, *[elements[i].alias(name) for i, name in enumerate(names)])


def anomaly_pipeline(
    features: Sequence[str] = FEATURES, label: str = LABEL, trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol=UNSCALED)
    forest = RandomForestClassifier(featuresCol=SCALED, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[assembler, _scaler(), forest])


def train(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    key: str | None = None,
    partitions: int | None = None,
    rows_each: int | None = None,
    most_rows: int | None = None,
    combine_equal: bool = False,
    copies: int = COPIES,
    **forest: int,
) -> PipelineModel:
    """Fit the pipeline on the columns it needs.

    A forest depends on how its rows are laid out. With ``key``, a column that names each row, and
    ``partitions``, rows are dealt by the key and sorted, so the same rows give the same forest on
    any machine. ``partitions`` should be the number of cores that train, since the forest visits the
    rows once per tree level with the input's own parallelism. With ``rows_each`` there are more partitions for
    more rows than ``partitions`` hold at so many each. The laid-out columns are persisted while the fit goes over them.

    It also keeps one sampling count per row and tree, far more than the reading itself. For very
    long histories ``most_rows`` bounds the fit to about so many rows, chosen by a hash of the key
    (off by default), and ``combine_equal`` turns equal readings into one weighted row first:
    readings have two decimals, so there are only so many. All readings then still count. So that the
    trees sample readings, and not only distinct ones, a reading that stands n times is ``min(n, copies)``
    rows of equal weight: up to ``copies`` a tree draws it as often as it would the single readings, beyond that
    as if so many stood for all. The fit holds at most ``copies`` times the distinct readings.
    """
    if key is None and most_rows is not None:
        raise ValueError("most_rows needs a key to choose rows by")
    rows = df.select(*dict.fromkeys([*features, label, *([key] if key else [])]))
    if most_rows is not None:
        total = rows.count()
        if total > most_rows:
            rows = rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * most_rows / total))
    pipeline = anomaly_pipeline(features, label, **forest)

    def laid_out(frame: DataFrame, by: Sequence[str]) -> DataFrame:
        if not partitions:
            return frame
        n = max(partitions, -(-frame.count() // rows_each)) if rows_each else partitions
        return frame.repartition(n, *by).sortWithinPartitions(*by) if by else frame.repartition(n)

    if not combine_equal:
        # The scaler and the forest go over the rows several times before the forest keeps its own copy.
        laid = laid_out(rows, [key] if key else []).select(*features, label).persist()
        try:
            return pipeline.fit(laid)
        finally:
            laid.unpersist()
    assembler, scaler, trees = pipeline.getStages()
    # The scaler knows no weights, so it is fitted on the single readings.
    scaling = scaler.fit(assembler.transform(rows.select(*features)))
    combined = rows.groupBy(*features, label).agg(F.count("*").alias("_times"))
    parts = F.least(F.col("_times"), F.lit(max(1, copies)))
    combined = combined.withColumn("weight", F.col("_times") / parts).withColumn("_part", F.explode(F.sequence(F.lit(1), parts.cast("int"))))
    grown = trees.setWeightCol("weight").fit(scaling.transform(assembler.transform(laid_out(combined, [*features, label, "_part"]))))
    return PipelineModel([assembler, scaling, grown])


def spread(df: DataFrame, key: str, rows_each: int) -> DataFrame:
    """``df`` dealt by ``key`` over tasks of about ``rows_each`` rows; a table that small stays as it is.

    Every tree is walked for every row, while a file is read by as many tasks as its bytes and row groups allow.
    """
    n = -(-df.count() // rows_each)
    return df.repartition(n, key) if n > 1 else df


def score(model: PipelineModel, df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Add ``prediction``; the same call for batch and streaming frames.

    A reading with a missing feature gets a null prediction. With the assembler's stored setting
    one such reading would end the job, and with it the stream. ``also`` takes the classifier's
    other outputs, ``rawPrediction`` and ``probability``; left out, they are not computed.
    """

    def adapted(stage):
        if isinstance(stage, VectorAssembler):
            return stage.copy({stage.handleInvalid: "keep"})
        if isinstance(stage, RandomForestClassificationModel) and not also:
            return stage.copy({stage.rawPredictionCol: "", stage.probabilityCol: ""})
        return stage

    features = [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    missing = any_of(is_missing(F.col(c)) for c in features)
    found = [F.when(~missing, F.col(c)).alias(c) for c in (*also, "prediction")]
    return PipelineModel([adapted(s) for s in model.stages]).transform(df).select(*df.columns, *found)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """Load a saved pipeline. Takes the session, since loading needs one to be running."""
    return PipelineModel.read().session(spark).load(path)
