import pytest
from pyspark.sql import functions as F

from missive.models.classifier import EmbeddingClassifier, TextClassifier
from missive.operators import cascade
from missive.plans.comparison import report_lines

CASES = [
    # low, high, p1, p2 → prediction, stage, confidence
    (0.1, 0.9, 0.10, 0.7, 0, 1, 0.90),
    (0.1, 0.9, 0.90, 0.1, 1, 1, 0.90),
    (0.1, 0.9, 0.11, 0.50, 1, 2, 0.50),
    (0.1, 0.9, 0.89, 0.49, 0, 2, 0.51),
    (0.6, 0.4, 0.50, 0.9, 0, 1, 0.50),
]


@pytest.mark.parametrize(("low", "high", "p1", "p2", "prediction", "stage", "confidence"), CASES)
def test_cascade_rows(spark, low, high, p1, p2, prediction, stage, confidence):
    first = spark.createDataFrame([(1, 1, p1)], "msg_id bigint, y int, p double")
    second = spark.createDataFrame([(1, p2)], "msg_id bigint, p double")
    row = cascade.cascade_rows(first, second, low, high).first()
    assert (row.prediction, row.stage_used) == (prediction, stage)
    assert row.confidence == pytest.approx(confidence)
    assert row.stage1_proba == p1 and row.stage2_proba == (p2 if stage == 2 else None)
    assert row.p == (p2 if stage == 2 else p1)


def test_stage_stats_and_metrics(spark):
    first = spark.createDataFrame(
        [(1, 0, 0.05), (2, 1, 0.95), (3, 1, 0.5), (4, 0, 0.5)], "msg_id bigint, y int, p double"
    )
    second = spark.createDataFrame([(3, 0.8), (4, 0.6)], "msg_id bigint, p double")
    rows = cascade.cascade_rows(first, second)
    assert tuple(cascade.stage_stats(rows).first()) == (4, 2, 2, 50.0, 50.0)
    got = {r.model: r for r in cascade.stage_metrics(rows).collect()}
    assert got["Stage1"].accuracy == 1.0 and got["Stage1"].roc_auc is None
    assert got["Stage2"].precision == 0.5 and got["HybridCascade"].n == 4
    assert got["HybridCascade"].roc_auc == 1.0


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    base = spark.range(200).select(
        n.alias("msg_id"), (n % 2).cast("int").alias("y"), ((n * 37 % 101) / 101.0).alias("noise")
    )
    from pyspark.ml.functions import array_to_vector

    signal = F.array(F.col("y") * 0.6 + F.col("noise") * 0.8, (F.col("msg_id") % 7).cast("double"))
    return base.withColumn("features", array_to_vector(signal)).withColumn("embedding", signal)


def test_hybrid_cascade_end_to_end(spark, rows, tmp_path):
    text, vector = TextClassifier().fit(rows), EmbeddingClassifier().fit(rows)
    sent = []

    def encode(df):
        sent.append(df)
        return df

    hybrid = cascade.HybridCascade(text, vector, 0.3, 0.7, encode=encode)
    assert hybrid.fit(rows) is hybrid
    detail = hybrid.predict_with_metadata(rows)
    stage1 = {r.msg_id: r for r in text.score(rows).collect()}
    for r in detail.collect():
        if r.stage_used == 1:
            assert r.prediction == int(stage1[r.msg_id].p >= 0.7)
    unsure = detail.where("stage_used = 2").count()
    assert 0 < unsure < 200 and sent[0].count() == unsure
    assert hybrid.predict(rows).count() == 200 and hybrid.predict_proba(rows).where("p is null").count() == 0
    assert hybrid.evaluate(rows).where("model = 'HybridCascade'").first().accuracy > 0.7

    hybrid.save(spark, str(tmp_path / "h"))
    again = cascade.HybridCascade.load(spark, str(tmp_path / "h"))
    same = again.predict_with_metadata(rows).select("msg_id", "prediction", "stage_used")
    assert sorted(same.collect()) == sorted(detail.select("msg_id", "prediction", "stage_used").collect())

    stages, stats = hybrid.evaluate(rows), cascade.stage_stats(detail)
    lines = [r.value for r in report_lines(stages.drop("n"), stages, stats).orderBy("n").collect()]
    assert lines[0] == "Test rows by approach" and any("second stage decided" in line for line in lines)


def test_a_missing_score_is_an_error(spark):
    first = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.05)], "msg_id bigint, y int, p double")
    second = spark.createDataFrame([(2, 0.4)], "msg_id bigint, p double")
    with pytest.raises(Exception, match="stage-2 score"):
        cascade.cascade_rows(first, second).collect()


class Scores:
    """A stage whose scores stand in a column."""

    def __init__(self, column):
        self.column = column

    def score(self, df):
        return df.withColumn("p", F.col(self.column)).withColumn("pred", (F.col("p") > 0.5).cast("int"))


def test_decisions_compare_scores_as_the_thresholds_were_rounded(spark, rows, tmp_path):
    sure = [(1, 0, 0.2500003, 0.9), (2, 1, 0.7499997, 0.1)]  # at the thresholds, but for the digits that these lack
    table = spark.createDataFrame([*sure, (3, 1, 0.5, 0.4999997)], "msg_id bigint, y int, a double, b double")
    hybrid = cascade.HybridCascade(Scores("a"), Scores("b"), 0.25, 0.75, digits=6)
    found = hybrid.predict_with_metadata(table).orderBy("msg_id").select("prediction", "stage_used").collect()
    assert [tuple(r) for r in found] == [(0, 1), (1, 1), (1, 2)]
    fitted = TextClassifier("NearestCentroid").fit(rows), EmbeddingClassifier("GaussianNB").fit(rows)
    cascade.HybridCascade(*fitted, digits=6).save(spark, str(tmp_path / "d"))
    assert cascade.HybridCascade.load(spark, str(tmp_path / "d")).digits == 6
