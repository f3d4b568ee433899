"""The two-stage cascade: a cheap text model decides what it is sure of, an embedding model the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as S
from . import metrics


def _column(value: Column | float) -> Column:
    return F.lit(float(value)) if isinstance(value, (int, float)) else value


def uncertain(stage1: DataFrame, low: Column | float = S.STAGE1_LOW, high: Column | float = S.STAGE1_HIGH) -> DataFrame:
    """The rows stage 2 has to score.  Apply it before encoding: the filter does not sink below Python."""
    return stage1.where((F.col("p") > _column(low)) & (F.col("p") < _column(high)))


def cascade_rows(
    stage1: DataFrame,
    stage2: DataFrame,
    low: Column | float = S.STAGE1_LOW,
    high: Column | float = S.STAGE1_HIGH,
    stage2_threshold: Column | float = S.STAGE2_THRESHOLD,
    id_col: str = "msg_id",
) -> DataFrame:
    """Decide every row of ``stage1`` (id, y, p).

    ``stage2`` (id, p) needs rows for the uncertain messages only; others are ignored.  An uncertain message without a
    stage-2 score, and any message without a stage-1 score, is an error.  Thresholds are numbers or scalar columns.  Result: prediction, confidence, stage_used, stage1_proba, stage2_proba (null where stage 1
    decided) and the final probability ``p``.
    """
    low, high, cut = _column(low), _column(high), _column(stage2_threshold)
    second = stage2.select(id_col, F.col("p").alias("_p2"))
    rows = stage1.join(second, id_col, "left")
    no_score = F.raise_error(F.lit("A message has no stage-1 score")).cast("double")
    p1 = F.when(F.col("p").isNull(), no_score).otherwise(F.col("p"))
    used = S.stage_used(p1, low, high)
    no_second = F.raise_error(F.lit("An uncertain message has no stage-2 score")).cast("double")
    p2 = F.when((used == 2) & F.col("_p2").isNull(), no_second).otherwise(F.col("_p2"))
    return rows.select(
        *[c for c in stage1.columns if c not in ("p", "pred")],
        S.cascade_prediction(p1, p2, low, high, cut).alias("prediction"),
        S.cascade_confidence(p1, p2, low, high, cut).alias("confidence"),
        used.alias("stage_used"),
        p1.alias("stage1_proba"),
        F.when(used == 2, p2).alias("stage2_proba"),
    ).withColumn("p", F.coalesce("stage2_proba", "stage1_proba"))


def stage_stats(rows: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    first, second = F.count_if(F.col("stage_used") == 1), F.count_if(F.col("stage_used") == 2)
    return rows.agg(
        n.alias("total"),
        first.alias("stage1_count"),
        second.alias("stage2_count"),
        (S.ratio(first, n) * 100).alias("stage1_pct"),
        (S.ratio(second, n) * 100).alias("stage2_pct"),
    )


def stage_metrics(rows: DataFrame) -> DataFrame:
    """Rates per deciding stage and overall; ranking metrics for the whole only."""
    named = rows.withColumn("pred", F.col("prediction")).withColumn(
        "stage", F.when(F.col("stage_used") == 1, "Stage1").otherwise("Stage2")
    )
    cells = named.rollup("stage").agg(*metrics.cell_counts())
    rates = metrics._rates()
    ranked = metrics.ranking_metrics(named)
    # AQE reuses the scored rows' exchange for the two scalars
    auc, ap = (ranked.select(c).scalar() for c in ("roc_auc", "avg_precision"))
    whole = F.col("stage").isNull()
    return cells.select(
        F.coalesce("stage", F.lit("HybridCascade")).alias("model"),
        *[rates[c].alias(c) for c in ("n", *metrics.RATE_COLUMNS)],
        F.when(whole, auc).alias("roc_auc"),
        F.when(whole, ap).alias("avg_precision"),
    ).where((F.col("n") > 0))


class HybridCascade:
    """Two fitted models and three thresholds.

    ``stage1`` and ``stage2`` have ``score(df) -> df + (p, pred)``.  ``encode`` turns the uncertain rows into
    stage 2's input; by default they carry it already.  Thresholds that were tuned on rounded scores need ``digits``:
    both scores are rounded to as many before they are compared.
    """

    CONFIG = (
        "stage1_low_threshold double, stage1_high_threshold double, stage2_threshold double, "
        "stage1_kind string, stage2_kind string, digits int"
    )

    def __init__(
        self,
        stage1,
        stage2,
        stage1_low_threshold: float = S.STAGE1_LOW,
        stage1_high_threshold: float = S.STAGE1_HIGH,
        stage2_threshold: float = S.STAGE2_THRESHOLD,
        encode: Callable[[DataFrame], DataFrame] | None = None,
        id_col: str = "msg_id",
        digits: int | None = None,
    ):
        self.stage1 = stage1
        self.stage2 = stage2
        self.stage1_low_threshold = stage1_low_threshold
        self.stage1_high_threshold = stage1_high_threshold
        self.stage2_threshold = stage2_threshold
        self.encode = encode
        self.id_col = id_col
        self.digits = digits

    def _scores(self, stage, df: DataFrame) -> DataFrame:
        scored = stage.score(df)
        return scored if self.digits is None else scored.withColumn("p", F.round("p", self.digits))

    def fit(self, df: DataFrame) -> HybridCascade:
        """Both stages are fitted already."""
        return self

    def predict_with_metadata(self, df: DataFrame) -> DataFrame:
        scored = self._scores(self.stage1, df)
        unsure = uncertain(scored, self.stage1_low_threshold, self.stage1_high_threshold).drop("p", "pred")
        if self.encode is not None:
            unsure = self.encode(unsure)
        second = self._scores(self.stage2, unsure).select(self.id_col, "p")
        keep = [c for c in (self.id_col, "y") if c in scored.columns]
        return cascade_rows(
            scored.select(*keep, "p"),
            second,
            self.stage1_low_threshold,
            self.stage1_high_threshold,
            self.stage2_threshold,
            self.id_col,
        )

    def predict(self, df: DataFrame) -> DataFrame:
        return self.predict_with_metadata(df).select(self.id_col, "prediction")

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return self.predict_with_metadata(df).select(self.id_col, "p")

    def evaluate(self, df: DataFrame) -> DataFrame:
        return stage_metrics(self.predict_with_metadata(df))

    def save(self, spark, directory: str) -> None:
        self.stage1.save(f"{directory}/stage1")
        self.stage2.save(f"{directory}/stage2")
        config = {
            "stage1_low_threshold": self.stage1_low_threshold,
            "stage1_high_threshold": self.stage1_high_threshold,
            "stage2_threshold": self.stage2_threshold,
            "stage1_kind": type(self.stage1).__name__,
            "stage2_kind": type(self.stage2).__name__,
            "digits": self.digits,
        }
        spark.createDataFrame([config], self.CONFIG).coalesce(1).write.mode("overwrite").json(f"{directory}/config")

    @classmethod
    def load(cls, spark, directory: str, encode: Callable[[DataFrame], DataFrame] | None = None) -> HybridCascade:
        from ..models.classifier import load_classifier

        config = spark.read.schema(cls.CONFIG).json(f"{directory}/config").first()
        return cls(
            load_classifier(spark, f"{directory}/stage1", config.stage1_kind),
            load_classifier(spark, f"{directory}/stage2", config.stage2_kind),
            config.stage1_low_threshold,
            config.stage1_high_threshold,
            config.stage2_threshold,
            encode,
            digits=config.digits,
        )
