"""Evaluation of a scored, labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.operators.features import side_by_side
from flowwarden.operators.positions import ordered_position


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Rows: true class; columns: predicted 0 and 1."""
    return scored.groupBy(label).agg(
        F.count_if(F.col(pred) == 0).alias("pred_0"), F.count_if(F.col(pred) == 1).alias("pred_1")
    )


def _outcomes(scored: DataFrame, label: str, pred: str) -> DataFrame:
    """True/false positives/negatives of class 1, one row."""

    def cell(truth: int, guess: int) -> Column:
        return F.count_if((F.col(label) == truth) & (F.col(pred) == guess)).cast("double")

    return scored.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _class_scores(hit: Column, false_alarm: Column, missed: Column) -> tuple[Column, Column, Column]:
    precision = _ratio(hit, hit + false_alarm)
    recall = _ratio(hit, hit + missed)
    return precision, recall, _ratio(2 * hit, 2 * hit + false_alarm + missed)


def binary_metrics(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; a ratio without a base is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall, f1 = _class_scores(tp, fp, fn)
    return _outcomes(scored, label, pred).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def classification_report(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    one = _class_scores(tp, fp, fn)
    zero = _class_scores(tn, fn, fp)
    n1, n0 = tp + fn, tn + fp
    total = n0 + n1

    def row(name: str, scores, support: Column) -> Column:
        p, r, f = scores
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    accuracy = _ratio(tp + tn, total)
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [_ratio(a * n0 + b * n1, total) for a, b in zip(zero, one)]
    rows = F.array(
        row("0", zero, n0),
        row("1", one, n1),
        row("accuracy", [accuracy] * 3, total),
        row("macro avg", macro, total),
        row("weighted avg", weighted, total),
    )
    return _outcomes(scored, label, pred).select(F.inline(rows))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; tied scores share their rank.  Null without both classes.

    Rows are first counted per distinct score; the running count over scores is a chunked prefix
    sum, so no task needs to see them all.
    """
    counts = scored.groupBy(score).agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    running = ordered_position(counts, [score], weight=F.col("n0"), name="upto")
    # Twice the number of (negative, positive) pairs in the right order, ties counting half.
    won = F.col("n1").cast("decimal(18,0)") * (2 * F.col("upto") - F.col("n0")).cast("decimal(19,0)")
    sums = running.agg(
        F.sum(won).cast("double").alias("won"), F.sum("n0").alias("neg"), F.sum("n1").alias("pos")
    )
    pairs = F.col("neg").cast("double") * F.col("pos").cast("double")
    return sums.select(F.try_divide(F.col("won"), 2 * pairs).alias("roc_auc"))


def evaluate(scored: DataFrame, label: str = "label", pred: str = "pred", score: str = "score") -> DataFrame:
    """All binary metrics and the area under the curve, one row."""
    return side_by_side(binary_metrics(scored, label, pred), roc_auc(scored, label, score))
