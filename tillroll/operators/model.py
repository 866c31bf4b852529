"""Binary scorer of candidate pairs: gradient-boosted trees of Spark ML.

Any fitted ML model with a probability column will do in its place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.sampling import stratified_split


@dataclass
class TrainConfig:
    max_iter: int = 60
    max_depth: int = 5
    step_size: float = 0.1
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    min_instances: int = 100
    max_bins: int = 256
    most_categories: int = 4096
    holdout: float = 0.1
    seed: int = 42


def _as_categories(rows: DataFrame, categorical: list[str], most: int) -> tuple[DataFrame, int]:
    """Mark code columns as categories, which trees split by sets of codes; and the bins
    that the largest takes. Columns of more than ``most`` codes stay ordered numbers."""
    if not categorical:
        return rows, 2
    top = rows.agg(*[F.max(c).alias(c) for c in categorical]).first()
    sizes = {c: int(top[c] or 0) + 1 for c in categorical if (top[c] or 0) < most}
    marked = {c: F.col(c).cast("double").alias(c, metadata={"ml_attr": {"type": "nominal", "name": c, "num_vals": max(n, 2)}}) for c, n in sizes.items()}
    return rows.select(*[marked.get(c, F.col(c)) for c in rows.columns]), max([2, *sizes.values()])


def train_gbt(matrix: DataFrame, features: list[str], config: TrainConfig | None = None, weight: str | None = None, categorical: list[str] | None = None) -> tuple[PipelineModel, float]:
    """Fit on all but the holdout, which also stops early; model and holdout ROC AUC.

    ``categorical`` names the features that hold category codes. ``matrix`` should be
    a written table: it is read several times.
    """
    config = config or TrainConfig()
    rows = stratified_split(matrix, config.holdout, config.seed).withColumn("label", F.col("target").cast("double"))
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    chosen = [c for c in categorical or [] if c in features]
    rows, bins = _as_categories(rows.withColumns({c: F.col(c).cast("double") for c in features}), chosen, config.most_categories)
    ready = assembler.transform(rows)
    trees = GBTClassifier(
        maxIter=config.max_iter, maxDepth=config.max_depth, stepSize=config.step_size, subsamplingRate=config.subsampling_rate, featureSubsetStrategy=config.feature_subset,
        minInstancesPerNode=config.min_instances, maxBins=max(config.max_bins, bins), seed=config.seed, validationIndicatorCol="holdout", **({"weightCol": weight} if weight else {}),
    )
    ready = ready.persist()
    try:
        model = trees.fit(ready)
        scored = model.transform(ready.where("holdout"))
        auc = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(scored)
    finally:
        ready.unpersist()
    return PipelineModel([assembler, model]), auc


def predict_scores(matrix: DataFrame, model: PipelineModel | Model) -> DataFrame:
    """Add ``score``, the probability of target 1, scored in the JVM."""
    named = [c for stage in getattr(model, "stages", [model]) if isinstance(stage, VectorAssembler) for c in stage.getInputCols()]
    out = model.transform(matrix.withColumns({c: F.col(c).cast("double") for c in named}))
    return out.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """feature, importance, highest first."""
    assembler, trees = model.stages[0], model.stages[-1]
    pairs = [(n, float(v)) for n, v in zip(assembler.getInputCols(), trees.featureImportances.toArray())]
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
