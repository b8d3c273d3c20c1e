"""The matcher: gradient-boosted trees over pair features, MLlib's (MatcherConfig) or grown leaf-wise (BoostingConfig)."""

from __future__ import annotations

import hashlib

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.config import BoostingConfig, MatcherConfig
from kinloom.operators import boosting
from kinloom.operators.features import MODEL_COLUMNS
from kinloom.operators.labeling import require_none
from kinloom.operators.sampling import least_rows

#: Stands for missing evidence, which trees need as a number; all true values are greater.
SENTINEL = -1.0
NEVER = {"source1_entity_id", "candidate_entity_id", "dataset_split", "label", "q", "r"}


def _checked(df: DataFrame, columns: list[str]) -> DataFrame:
    if NEVER & set(columns):
        raise ValueError(f"not features: {', '.join(sorted(NEVER & set(columns)))}")
    infinite = [F.abs(F.col(c).cast("double")) == float("inf") for c in columns]
    require_none(df.where(F.exists(F.array(*infinite), lambda x: x)).select("source1_entity_id", "candidate_entity_id"), "infinite feature")
    return df


def _filled(df: DataFrame, columns: list[str]) -> DataFrame:
    return _checked(df, columns).withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(SENTINEL)), F.lit(SENTINEL)) for c in columns})


def sampled_rows(df: DataFrame, limit: int | None, seed: int) -> DataFrame:
    """All rows, or a uniform sample of `limit` pairs that does not depend on partitions."""
    if limit is None:
        return df
    key = ("source1_entity_id", "candidate_entity_id")
    return least_rows(df, limit, F.xxhash64(*key, F.lit(seed)), *key)


def _train_leafwise(features: DataFrame, config: BoostingConfig, columns: list[str]) -> boosting.Booster:
    splits = (("train", config.max_train_pairs, config.seed), ("validation", config.max_early_stopping_pairs, config.seed + 1))
    learned, held = (sampled_rows(features.where(F.col("dataset_split") == name), limit, seed) for name, limit, seed in splits)
    key = F.xxhash64("source1_entity_id", "candidate_entity_id").alias("key")
    rows = _checked(learned.unionByName(held), columns)
    return boosting.train(rows.select(key, F.col("label").cast("double").alias("label"), (F.col("dataset_split") == "validation").alias("held"), *columns), columns, config)


def train(features: DataFrame, config: MatcherConfig | BoostingConfig, columns: list[str] | None = None) -> PipelineModel | boosting.Booster:
    """Fit on the train split and stop by the validation split."""
    columns = columns or MODEL_COLUMNS
    require_none(features.where(~F.col("label").isin(0, 1) | F.col("label").isNull()).select("label"), "label that is neither 0 nor 1")
    if isinstance(config, BoostingConfig):
        return _train_leafwise(features, config, columns)
    learned = sampled_rows(features.where("dataset_split = 'train'"), config.max_training_rows, config.seed)
    found = {r["label"] for r in learned.select("label").distinct().collect()}
    if found != {0, 1}:
        raise ValueError("training needs both labels")
    rows = learned.unionByName(features.where("dataset_split = 'validation'"))
    given = _filled(rows, columns).select(*columns, F.col("label").cast("double").alias("label"), (F.col("dataset_split") == "validation").alias("held"))
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=config.max_iter, maxDepth=config.max_depth, maxBins=config.max_bins, stepSize=config.step_size,
        minInstancesPerNode=config.min_instances, featureSubsetStrategy=config.feature_subset, seed=config.seed, validationIndicatorCol="held",
    )
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), trees]).fit(given)


def save(model: PipelineModel | boosting.Booster, spark: SparkSession, path: str) -> None:
    if isinstance(model, boosting.Booster):
        model.save(spark, path)
    else:
        model.write().save(path)


def load(spark: SparkSession, path: str, leafwise: bool = False) -> PipelineModel | boosting.Booster:
    return boosting.Booster.load(spark, path) if leafwise else PipelineModel.load(path)


def feature_columns(model: PipelineModel | boosting.Booster) -> list[str]:
    if isinstance(model, boosting.Booster):
        return model.columns
    return model.stages[0].getInputCols()


def predict(model: PipelineModel | boosting.Booster, features: DataFrame) -> DataFrame:
    """A match probability for every pair."""
    if isinstance(model, boosting.Booster):
        return boosting.predict(model, _checked(features, model.columns), ["source1_entity_id", "candidate_entity_id"])
    scored = model.transform(_filled(features, feature_columns(model)))
    return scored.select("source1_entity_id", "candidate_entity_id", vector_to_array("probability")[1].alias("match_probability"))


def fingerprint(model: PipelineModel | boosting.Booster) -> str:
    """The same for equal trees over equal columns."""
    if isinstance(model, boosting.Booster):
        return model.fingerprint()
    return hashlib.sha256("\n".join([*feature_columns(model), model.stages[-1].toDebugString.partition("\n")[2]]).encode()).hexdigest()


def importances(model: PipelineModel | boosting.Booster) -> list[tuple]:
    """Features by falling gain; of leaf-wise trees also how often each is cut."""
    if isinstance(model, boosting.Booster):
        return model.importances()
    gains = model.stages[-1].featureImportances.toArray()
    return sorted(zip(feature_columns(model), map(float, gains), strict=True), key=lambda x: (-x[1], x[0]))


def learning_curve(model: PipelineModel | boosting.Booster, features: DataFrame) -> list[float]:
    """Loss on the given pairs after each tree; of leaf-wise trees, on those that training stopped by."""
    if isinstance(model, boosting.Booster):
        return [held for _, held in model.curve]
    given = _filled(features, feature_columns(model)).withColumn("label", F.col("label").cast("double"))
    return [float(x) for x in model.stages[-1].evaluateEachIteration(model.stages[0].transform(given))]
