"""Decision thresholds tuned on scored rows (y, p)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import STAGE2_THRESHOLD, ratio
from .distribution import percentiles_from_totals, running_totals
from .metrics import pr_curve

METRICS = ("f1", "precision", "recall")


def _first_best(curve: DataFrame, score: Column, closing: float) -> DataFrame:
    """The row with the highest score; of equals, the lowest threshold.  The closing point stands last."""
    last = F.col("threshold").isNull()
    # the struct orders by score, then by position from the end
    rank = F.struct(
        score.alias("score"), (~last).alias("on_curve"), (-F.coalesce("threshold", F.lit(0.0))).alias("at")
    )
    row = F.struct(
        F.coalesce("threshold", F.lit(closing)).alias("threshold"), "precision", "recall", score.alias("score")
    )
    return curve.agg(F.max_by(row, rank).alias("best")).select("best.*")


def best_threshold(scored: DataFrame, metric: str = "f1") -> DataFrame:
    """(threshold, score): the first maximum of the metric along the precision-recall curve."""
    if metric not in METRICS:
        raise ValueError(f"Unknown metric: {metric}. Expected one of {METRICS}.")
    precision, recall = F.col("precision"), F.col("recall")
    score = 2 * precision * recall / (precision + recall + 1e-10) if metric == "f1" else F.col(metric)
    return _first_best(pr_curve(scored), score, closing=0.5).select("threshold", "score")


def high_recall_threshold(scored: DataFrame, target_recall: float = 1.0) -> DataFrame:
    """(threshold, precision, recall) of the best precision with the recall reached; nulls if it never is."""
    reached = pr_curve(scored).where(F.col("recall") >= target_recall)
    return _first_best(reached, F.col("precision"), closing=0.0).select("threshold", "precision", "recall")


def _points(scored: DataFrame) -> DataFrame:
    return scored.groupBy("p").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )


def coverage(scored: DataFrame, low: Column, high: Column) -> Column:
    """Share of rows that stage 1 decides: all but those strictly between the thresholds (a scalar)."""
    between = (F.col("p") > low) & (F.col("p") < high)
    return scored.agg((1 - ratio(F.count_if(between), F.count(F.lit(1))))).scalar()


def cascade_thresholds(
    scored: DataFrame, low_pct: float = 20, high_pct: float = 80, digits: int | None = None
) -> DataFrame:
    """One row: the 20th percentile of the ham scores, the 80th of the spam scores, coverage, stage 2 at 0.5.

    ``digits`` rounds the two thresholds before the coverage is counted.
    """
    totals = running_totals(_points(scored), "p", ["pos", "neg"])
    pair = percentiles_from_totals(
        totals, "p", {"stage1_low": ("neg", low_pct / 100), "stage1_high": ("pos", high_pct / 100)}
    )
    if digits is not None:
        pair = pair.select(*[F.round(c, digits).alias(c) for c in pair.columns])
    low, high = pair.select("stage1_low").scalar(), pair.select("stage1_high").scalar()
    return pair.select(
        F.col("stage1_low").alias("stage1_low_threshold"),
        F.col("stage1_high").alias("stage1_high_threshold"),
        coverage(scored, low, high).alias("stage1_coverage"),
        F.lit(STAGE2_THRESHOLD).alias("stage2_threshold"),
    )


def cascade_thresholds_target(
    scored: DataFrame, target_coverage: float = 0.8, target_recall: float = 1.0
) -> DataFrame:
    """Thresholds that honour both targets.

    Low is the largest score below the threshold of the best precision with the recall reached, so that
    stage 1 rejects as much ham as the target allows.  High is the largest score at which the rows outside
    (low, high) still make up the target coverage.  Where no score lies below, low is -1 (nothing rejected).
    """
    points = _points(scored)
    edge = high_recall_threshold(scored, target_recall).select("threshold").scalar()
    low = points.agg(F.coalesce(F.max(F.when(F.col("p") < edge, F.col("p"))), F.lit(-1.0))).scalar()
    totals = running_totals(points.withColumn("n", F.col("pos") + F.col("neg")), "p", ["n"])
    at_most_low = points.agg(
        F.coalesce(F.sum(F.when(F.col("p") <= low, F.col("pos") + F.col("neg"))), F.lit(0))
    ).scalar()
    # with high = p the undecided rows are those in (low, p)
    undecided = F.col("cum_n") - F.col("n") - at_most_low
    ok = (F.col("p") > low) & (1 - ratio(undecided, F.col("total_n")) >= target_coverage)
    chosen = totals.agg(F.coalesce(F.max(F.when(ok, F.col("p"))), low).alias("high"))
    high = chosen.scalar()
    return chosen.select(
        low.alias("stage1_low_threshold"),
        F.col("high").alias("stage1_high_threshold"),
        coverage(scored, low, high).alias("stage1_coverage"),
        F.lit(STAGE2_THRESHOLD).alias("stage2_threshold"),
    )


class ThresholdOptimizer:
    """Keeps the last tuned thresholds, so that they can be saved."""

    def __init__(self) -> None:
        self.thresholds: dict[str, float] = {}

    def find_cascade_thresholds(self, scored: DataFrame) -> dict[str, float]:
        self.thresholds = cascade_thresholds(scored).first().asDict()
        return self.thresholds

    def save_thresholds(self, spark, path: str) -> None:
        if not self.thresholds:
            raise ValueError("No thresholds were tuned, so there is nothing to write")
        spark.createDataFrame([self.thresholds]).coalesce(1).write.mode("overwrite").json(path)
