"""Labelled flows -> stored model and its evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.operators import metrics as M
from flowwarden.operators import sampling as P
from flowwarden.operators.features import quoted, training_frame
from flowwarden.operators.forest import save_model, score, train_forest
from flowwarden.operators.smote import smote
from flowwarden.schema import LABEL, ForestConfig
from flowwarden.session import durable


@dataclass
class Training:
    model: PipelineModel
    evaluation: DataFrame
    report: DataFrame
    confusion: DataFrame
    train_accuracy: DataFrame


def train(
    labelled: DataFrame,
    features: Sequence[str],
    key: str,
    label: str = LABEL,
    config: ForestConfig = ForestConfig(),
    oversample: bool = True,
    path: str | None = None,
) -> Training:
    """Split by label, keep the two labels, oversample the train part, fit, evaluate on the rest.

    `key` identifies a row.  Without oversampling the classes are weighted instead.  The forest is fitted on about
    `config.fit_rows` rows of the train part at most, chosen by a hash of the key; evaluation covers all of the rest.
    """
    features = list(features)
    parts = P.stratified_split(labelled, label, key, seed=config.seed)
    ready = durable(training_frame(parts, features, label, keep=[key, "split"]))
    fit_rows = ready.filter(F.col("split") == "train").drop("split")
    size = fit_rows.count()
    if size > config.fit_rows:
        fit_rows = fit_rows.filter(P.hash_mix(key, seed=config.seed + 3) < int(P.HASH_SPAN * config.fit_rows / size))
    weight = None
    if oversample:
        packed = fit_rows.select(key, F.array(*[quoted(f) for f in features]).alias("vec"), "target")
        grown = smote(packed, key, "vec", "target", seed=config.seed)
        fit_rows = grown.select(*[F.col("vec")[i].alias(f) for i, f in enumerate(features)], "target")
    else:
        fit_rows, weight = P.with_class_weight(fit_rows, "target"), "weight"
    fit_rows = durable(fit_rows)  # the forest reads it once per tree level
    model = train_forest(fit_rows, features, "target", weight, config)
    if path:
        save_model(model, path)
    held_out = durable(score(model, ready.filter(F.col("split") == "test")).select("target", "pred", "p"))
    train_scored = score(model, fit_rows)
    return Training(
        model=model,
        evaluation=M.evaluate(held_out, "target", "pred", "p"),
        report=M.classification_report(held_out, "target", "pred"),
        confusion=M.confusion_matrix(held_out, "target", "pred"),
        train_accuracy=M.binary_metrics(train_scored, "target", "pred").select("accuracy"),
    )
