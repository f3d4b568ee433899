"""Evaluation tables for binary predictions.

Input: one row per (model, message) with the truth ``y``, the prediction ``pred`` and, for ranking metrics, the
score ``p``.  ``by`` names grouping columns, so a whole leaderboard is one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import f_score, ratio
from .distribution import running_totals

CELLS = ("tp", "fp", "fn", "tn")


def cell_counts(y: str = "y", pred: str = "pred") -> list[Column]:
    # a row without a truth or a prediction would be in none of the cells
    missing = F.col(y).isNull() | F.col(pred).isNull()
    checked = F.when(missing, F.raise_error(F.lit("A row has no truth or no prediction"))).otherwise(F.col(pred))
    truth, guess = F.col(y) == 1, checked == 1
    return [
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    ]


def _rates() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in CELLS)
    rates = {
        "n": tp + fp + fn + tn,
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "ham_precision": ratio(tn, tn + fn),
        "ham_recall": ratio(tn, tn + fp),
    }
    rates["f1"] = f_score(rates["precision"], rates["recall"])
    rates["ham_f1"] = f_score(rates["ham_precision"], rates["ham_recall"])
    rates["f1_macro"] = (rates["f1"] + rates["ham_f1"]) / 2
    rates["f1_weighted"] = ratio(rates["f1"] * (tp + fn) + rates["ham_f1"] * (tn + fp), rates["n"])
    # a class that does not occur has no recall to average
    rates["balanced_accuracy"] = (
        F.when(tp + fn == 0, rates["ham_recall"])
        .when(tn + fp == 0, rates["recall"])
        .otherwise((rates["recall"] + rates["ham_recall"]) / 2)
    )
    # the area under the ROC curve of hard labels; null where one class is missing
    rates["hard_auc"] = F.when((tp + fn > 0) & (tn + fp > 0), rates["balanced_accuracy"])
    return rates


RATE_COLUMNS = ("accuracy", "precision", "recall", "f1", "f1_macro")


def rates(scored: DataFrame, columns: Sequence[str] = RATE_COLUMNS, by: Sequence[str] = ()) -> DataFrame:
    """Rates at the decision, one row per group; 0 where a rate is undefined."""
    cells = scored.groupBy(*by).agg(*cell_counts())
    available = _rates()
    return cells.select(*by, *[available[c].alias(c) for c in columns])


def confusion(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The 2 × 2 grid in long form (y, pred, n); empty cells are 0."""
    grid = F.array(
        F.struct(F.lit(0).alias("y"), F.lit(0).alias("pred"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("y"), F.lit(1).alias("pred"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(0).alias("pred"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(1).alias("pred"), F.col("tp").alias("n")),
    )
    return scored.groupBy(*by).agg(*cell_counts()).select(*by, F.inline(grid))


def class_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support: a row per class, then accuracy, macro and weighted average."""
    cells = scored.groupBy(*by).agg(*cell_counts())
    r = _rates()
    cells = cells.select(
        *by,
        *[r[c].alias(c) for c in ("n", "accuracy", "precision", "recall", "f1")],
        *[r[c].alias(c) for c in ("ham_precision", "ham_recall", "ham_f1", "f1_macro", "f1_weighted")],
        (F.col("tp") + F.col("fn")).alias("spam_n"),
        (F.col("tn") + F.col("fp")).alias("ham_n"),
    )

    def row(name: str, precision: Column, recall: Column, f1: Column, support: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col(support).alias("support"),
        )

    def weighted(name: str) -> Column:
        spam, ham = F.col(name), F.col(f"ham_{name}")
        return ratio(spam * F.col("spam_n") + ham * F.col("ham_n"), F.col("n"))

    def macro(name: str) -> Column:
        return (F.col(name) + F.col(f"ham_{name}")) / 2

    accuracy = F.col("accuracy")
    rows = F.array(
        row("ham", F.col("ham_precision"), F.col("ham_recall"), F.col("ham_f1"), "ham_n"),
        row("spam", F.col("precision"), F.col("recall"), F.col("f1"), "spam_n"),
        row("accuracy", accuracy, accuracy, accuracy, "n"),
        row("macro avg", macro("precision"), macro("recall"), F.col("f1_macro"), "n"),
        row("weighted avg", weighted("precision"), weighted("recall"), F.col("f1_weighted"), "n"),
    )
    return cells.select(*by, F.inline(rows))


def score_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest score down."""
    points = scored.groupBy(*by, "p").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    return running_totals(points, "p", ["pos", "neg"], by=by, descending=True)


def pr_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall): a point per distinct score and the closing point (null, 1, 0)."""
    points = score_points(scored, by)
    curve = points.select(
        *by,
        F.col("p").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        # without positives the recall is 1 by convention
        F.when(F.col("total_pos") == 0, F.lit(1.0)).otherwise(ratio(F.col("cum_pos"), F.col("total_pos"))).alias("recall"),
    )
    closing = points.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(closing)


def ranking_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve (ties count half) and average precision; null where only one class occurs."""
    points = score_points(scored, by)
    below = F.col("total_neg") - F.col("cum_neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    pos, neg = F.max("total_pos").cast("double"), F.max("total_neg").cast("double")
    gain = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    both = (pos > 0) & (neg > 0)
    return points.groupBy(*by).agg(
        F.when(both, F.try_divide(wins, pos * neg)).alias("roc_auc"),
        F.when(both, F.try_divide(gain, pos)).alias("avg_precision"),
    )


def evaluate(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The metrics row: accuracy, precision, recall, f1, f1_macro, roc_auc, avg_precision per group.

    Without a ``p`` column the two ranking metrics are null.
    """
    basic = rates(scored, by=by)
    if "p" not in scored.columns:
        none = F.lit(None).cast("double")
        return basic.withColumns({"roc_auc": none, "avg_precision": none})
    ranked = ranking_metrics(scored, by)
    if by:
        return basic.join(ranked, list(by), "left")
    return basic.withColumns(
        {c: ranked.select(c).scalar() for c in ("roc_auc", "avg_precision")}
    )


def spam_recall(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rates(scored, ["recall"], by).withColumnRenamed("recall", "spam_recall")


def ham_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rates(scored, ["ham_precision"], by)
