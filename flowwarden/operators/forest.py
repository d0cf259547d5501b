"""Random-forest training, scoring and storage on MLlib."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.operators.features import clean_numeric
from flowwarden.schema import ForestConfig
from flowwarden.session import scratch_path

#: Parts of a forest that are fitted at the same time, and the distance of their seeds.
PARTS = 4
SEED_STEP = 1_000_003


def train_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str = "target",
    weight: str | None = None,
    config: ForestConfig = ForestConfig(),
) -> PipelineModel:
    """Assemble, scale and fit in one stored pipeline, whose last stages are parts of the forest.

    Each pass over the rows fills a histogram a node of the part in every partition, also in an empty one.  So the
    forest is fitted in `PARTS` parts at the same time, each with its share of the trees, and the rows are dealt out
    evenly to as few partitions as keep all cores at work; more of them for more rows would make the work grow with
    the square of the rows.  A row's node in each tree is kept beside it, or each pass would send the trees to all tasks.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():  # the kept nodes' lineage grows with each pass unless it is cut
        context.setCheckpointDir(scratch_path(spark, "forest"))
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True),
    ]
    prepared = Pipeline(stages=stages).fit(df)
    count = min(PARTS, config.trees)
    shares = [config.trees // count + (i < config.trees % count) for i in range(count)]
    ready = prepared.transform(df).select("scaled", label, *([weight] if weight else []))
    ready = ready.repartition(-(-context.defaultParallelism // count)).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(i: int) -> RandomForestClassificationModel:
        forest = RandomForestClassifier(
            featuresCol="scaled",
            labelCol=label,
            rawPredictionCol=f"raw_{i}",
            probabilityCol=f"probability_{i}",
            predictionCol=f"prediction_{i}",
            numTrees=shares[i],
            maxDepth=config.depth,
            minInstancesPerNode=config.min_leaf,
            maxBins=config.max_bins,
            seed=config.seed + i * SEED_STEP,
            maxMemoryInMB=512,  # nodes in each pass over the rows; a task needs half as much again
            cacheNodeIds=True,
        )
        return (forest.setWeightCol(weight) if weight else forest).fit(ready)

    try:
        with ThreadPool(count) as pool:
            forests = pool.map(inheritable_thread_target(spark)(fit), range(count))
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*prepared.stages, *forests])


def model_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def score(model: PipelineModel, df: DataFrame, clean: bool = True) -> DataFrame:
    """Add `p` (probability of class 1) and `pred`; every other column of the row stays."""
    ready = clean_numeric(df, model_features(model)) if clean else df
    scored = model.transform(ready)
    forests = [s for s in model.stages if isinstance(s, RandomForestClassificationModel)]
    votes = [vector_to_array(f.getProbabilityCol())[1] * f.getNumTrees for f in forests]
    p = reduce(Column.__add__, votes) / sum(f.getNumTrees for f in forests)
    return scored.withColumn("p", p).select(*df.columns, "p", (F.col("p") > 0.5).cast("int").alias("pred"))


def save_model(model: PipelineModel, path: str) -> None:
    """Store the pipeline and its feature list side by side."""
    names = model_features(model)
    model.write().overwrite().save(os.path.join(path, "pipeline_model"))
    listing = SparkSession.active().createDataFrame([(names, len(names))], "features array<string>, count int")
    listing.coalesce(1).write.mode("overwrite").json(os.path.join(path, "feature_names"))


def load_model(path: str, features: Sequence[str] | None = None) -> PipelineModel:
    """Load a stored pipeline; fails when it was trained on other features."""
    model = PipelineModel.load(os.path.join(path, "pipeline_model"))
    if features is not None and model_features(model) != list(features):
        raise ValueError("stored model was trained on a different feature list")
    return model
