"""Classifier metrics from counts per distinct score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import ratio
from ..functions.running import RANGE_ROWS, running_totals


def score_counts(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col(label).cast("int") == 1
    return rows.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def roc_auc(rows: DataFrame, score: str, label: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Area under the ROC curve; equal scores count one half."""
    totals = running_totals(score_counts(rows, score, label), "score", ["neg"], range_rows=range_rows)
    below = F.col("cum_neg") - F.col("neg")
    wins = F.sum(F.col("pos") * (2 * below + F.col("neg"))).cast("double")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double") * 2.0
    return totals.agg(ratio(wins, pairs).alias("roc_auc"))


def threshold_counts(rows: DataFrame, score: str, label: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """True and false positives when everything at or above a score is flagged."""
    counts = score_counts(rows, score, label)
    totals = running_totals(counts, "score", ["pos", "neg"], descending=True, range_rows=range_rows)
    whole = totals.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    return totals.withColumn("whole", whole).select(
        F.col("score").alias("threshold"),
        "pos",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("whole.pos").alias("all_pos"),
        F.col("whole.neg").alias("all_neg"),
    )


def average_precision(rows: DataFrame, score: str, label: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Sum of recall steps times precision over distinct thresholds."""
    step = F.col("pos") * ratio("tp", F.col("tp") + F.col("fp"))
    return threshold_counts(rows, score, label, range_rows).agg(
        ratio(F.sum(step), F.max("all_pos")).alias("average_precision")
    )


def roc_pr_curves(rows: DataFrame, score: str, label: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """ROC and precision-recall points per distinct threshold.

    The fixed end points (0, 0) and (recall 0, precision 1) are not repeated here.
    """
    return threshold_counts(rows, score, label, range_rows).select(
        "threshold",
        ratio("fp", "all_neg").alias("fpr"),
        ratio("tp", "all_pos").alias("tpr"),
        ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
        ratio("tp", "all_pos").alias("recall"),
    )


def _outcomes(score: str, label: str, threshold: float) -> dict[str, Column]:
    actual = F.col(label).cast("int") == 1
    flagged = F.col(score) >= F.lit(threshold)
    return {
        "tn": F.count_if(~actual & ~flagged),
        "fp": F.count_if(~actual & flagged),
        "fn": F.count_if(actual & ~flagged),
        "tp": F.count_if(actual & flagged),
    }


def confusion_matrix(rows: DataFrame, score: str, label: str, threshold: float = 0.75) -> DataFrame:
    return rows.agg(*[c.alias(name) for name, c in _outcomes(score, label, threshold).items()])


def classification_report(rows: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy and averages."""
    c = {name: F.col(name).cast("double") for name in ("tn", "fp", "fn", "tp")}
    n = c["tn"] + c["fp"] + c["fn"] + c["tp"]

    def zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("long").alias("support"),
        )

    def class_parts(hit: Column, wrong: Column, missed: Column) -> tuple[Column, Column, Column, Column]:
        return (
            zero(ratio(hit, hit + wrong)),
            zero(ratio(hit, hit + missed)),
            zero(ratio(2.0 * hit, 2.0 * hit + wrong + missed)),
            hit + missed,
        )

    stay = class_parts(c["tn"], c["fn"], c["fp"])
    churn = class_parts(c["tp"], c["fp"], c["fn"])
    accuracy = zero(ratio(c["tn"] + c["tp"], n))
    macro = [(a + b) / 2.0 for a, b in zip(stay[:3], churn[:3])]
    weighted = [zero(ratio(a * stay[3] + b * churn[3], n)) for a, b in zip(stay[:3], churn[:3])]
    rows_out = [
        row("No Churn", *stay),
        row("Churn", *churn),
        row("accuracy", accuracy, accuracy, accuracy, n),
        row("macro avg", *macro, n),
        row("weighted avg", *weighted, n),
    ]
    return confusion_matrix(rows, score, label, threshold).select(F.inline(F.array(*rows_out)))
