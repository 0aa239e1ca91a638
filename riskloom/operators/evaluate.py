"""Evaluation of scored rows ``(label, score, pred)``, optionally per model.

``by`` names columns with few values, such as the model. Everything is one aggregate over the rows plus
windows over tables of fixed size; only the exact ROC-AUC handles one row per distinct score, in bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.numbers import safe_ratio
from riskloom.operators.ordered import fill_levels, running_totals

METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")


def _counts(label: str, pred: str) -> list[Column]:
    actual, guess = F.col(label), F.col(pred)
    return [
        F.count_if((actual == 0) & (guess == 0)).alias("tn"),
        F.count_if((actual == 0) & (guess == 1)).alias("fp"),
        F.count_if((actual == 1) & (guess == 0)).alias("fn"),
        F.count_if((actual == 1) & (guess == 1)).alias("tp"),
    ]


def confusion(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "pred"
) -> DataFrame:
    """``tn, fp, fn, tp`` per group."""
    return scored.groupBy(*by).agg(*_counts(label, pred))


def confusion_shares(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "pred"
) -> DataFrame:
    """The confusion matrix with each cell's share of all rows in percent."""
    cells = ("tn", "fp", "fn", "tp")
    total = sum((F.col(c) for c in cells[1:]), F.col("tn"))
    return confusion(scored, by, label, pred).withColumns(
        {f"{c}_pct": safe_ratio(F.col(c), total) * 100 for c in cells}
    )


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return matrix.withColumns(
        {
            "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
            "precision": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, tp + fn),
            "f1_score": safe_ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def business_metrics(matrix: DataFrame) -> DataFrame:
    """Add caught and missed positives, false alarms and both rates in percent."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return matrix.withColumns(
        {
            "fraud_caught": tp,
            "fraud_missed": fn,
            "caught_rate": safe_ratio(tp, tp + fn) * 100,
            "false_alarms": fp,
            "false_alarm_rate": safe_ratio(fp, fp + tn) * 100,
        }
    )


def score_counts(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
    pred: str = "pred",
) -> DataFrame:
    """Positives and negatives per distinct score. Equal scores collapse before the shuffle."""
    keys = [F.col(score).alias("_score"), F.col(pred).alias("_pred")] if pred else [
        F.col(score).alias("_score")
    ]
    return scored.filter(F.col(score).isNotNull()).groupBy(*by, *keys).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )


def _auc(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """ROC-AUC from ``score_counts``; the ranking runs in score bins, never in one task."""
    ranked = running_totals(counts, "_neg", "_score", by)
    wins = F.expr("sum(_pos * (cast(_neg_before AS double) + _neg / 2D))")
    pairs = F.expr("cast(sum(_pos) AS double) * sum(_neg)")
    return ranked.groupBy(*by).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def roc_auc(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in the right order,
    ties counting half. Null when a class is missing."""
    return _auc(score_counts(scored, by, label, score, pred=""), by)


def metrics_table(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
    pred: str = "pred",
) -> DataFrame:
    """Class metrics and ROC-AUC per group.

    Both come from the same counts per score, so the rows are scored and read once.
    """
    counts = score_counts(scored, by, label, score, pred)
    matrix = counts.groupBy(*by).agg(
        F.expr("coalesce(sum(if(_pred = 0, _neg, 0)), 0)").alias("tn"),
        F.expr("coalesce(sum(if(_pred = 1, _neg, 0)), 0)").alias("fp"),
        F.expr("coalesce(sum(if(_pred = 0, _pos, 0)), 0)").alias("fn"),
        F.expr("coalesce(sum(if(_pred = 1, _pos, 0)), 0)").alias("tp"),
    )
    per_score = counts.groupBy(*by, "_score").agg(
        F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg")
    )
    auc = _auc(per_score, by)
    if by:
        # one row per group
        return class_metrics(matrix).join(auc, list(by), "left")
    return class_metrics(matrix).withColumn("roc_auc", auc.scalar())


def threshold_counts(
    scored: DataFrame,
    steps: int = 100,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """For ``steps`` even thresholds in [0, 1]: how many positives and negatives score at least that.

    Each row is assigned to the highest threshold it reaches, so the work per row does not depend on
    the number of thresholds; the cumulative sum then runs over ``steps`` rows.
    """
    by, last = list(by), float(steps - 1)
    value = F.col(score)
    guess = F.floor(value * last)
    # the product may round across an edge; settle it with the comparison that defines the threshold
    reached = (
        F.when((guess + 1) / last <= value, guess + 1)
        .when(guess / last > value, guess - 1)
        .otherwise(guess)
    )
    level = F.greatest(F.least(reached, F.lit(steps - 1)), F.lit(-1)).cast("int")
    counted = (
        scored.filter(value.isNotNull())
        .groupBy(*by, level.alias("_level"))
        .agg(
            F.count_if(F.col(label) == 1).alias("_pos"),
            F.count_if(F.col(label) == 0).alias("_neg"),
        )
    )
    full = fill_levels(counted, "_level", -1, steps - 1, ["_pos", "_neg"], by)
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    above = whole.orderBy(F.desc("_level")).rowsBetween(Window.unboundedPreceding, 0)
    return full.select(
        *by,
        "_level",
        (F.col("_level") / last).alias("threshold"),
        F.sum("_pos").over(above).alias("tp"),
        F.sum("_neg").over(above).alias("fp"),
        F.sum("_pos").over(whole).alias("positives"),
        F.sum("_neg").over(whole).alias("negatives"),
    ).filter(F.col("_level") >= 0).drop("_level")


def threshold_sweep(scored: DataFrame, steps: int = 100, by: Sequence[str] = (), **names) -> DataFrame:
    """Precision, recall and F1 at each threshold."""
    tp, fp, positives = F.col("tp"), F.col("fp"), F.col("positives")
    return threshold_counts(scored, steps, by, **names).select(
        *by,
        "threshold",
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, positives).alias("recall"),
        safe_ratio(2 * tp, tp + fp + positives).alias("f1_score"),
    )


def roc_curve(scored: DataFrame, steps: int = 100, by: Sequence[str] = (), **names) -> DataFrame:
    """False and true positive rate at each threshold."""
    return threshold_counts(scored, steps, by, **names).select(
        *by,
        "threshold",
        safe_ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def pr_curve(scored: DataFrame, steps: int = 100, by: Sequence[str] = (), **names) -> DataFrame:
    """Recall and precision at each threshold; precision is 1 where nothing is flagged."""
    flagged = F.col("tp") + F.col("fp")
    return threshold_counts(scored, steps, by, **names).select(
        *by,
        "threshold",
        safe_ratio(F.col("tp"), F.col("positives")).alias("recall"),
        F.coalesce(F.try_divide(F.col("tp"), flagged), F.lit(1.0)).alias("precision"),
    )


def model_comparison(metrics: DataFrame, best_by: str = "f1_score", name: str = "model_name") -> DataFrame:
    """Mark the best model of a metrics table; ties go to the smaller name."""
    best = metrics.agg(F.min_by(name, F.struct(-F.col(best_by), F.col(name)))).scalar()
    return metrics.withColumn("is_best", (F.col(name) == best).cast("int"))
