import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from missive.operators import metrics, thresholds
from missive.operators.distribution import percentiles, running_totals
from missive.plans.leaderboard import best_model, leaderboard, top_models


def scored_frame(spark, y, p, cut=0.5):
    rows = [(i, int(a), float(b), int(b >= cut)) for i, (a, b) in enumerate(zip(y, p, strict=True))]
    return spark.createDataFrame(rows, "msg_id bigint, y int, p double, pred int")


def random_scores(seed, n=400, levels=25):
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2, n), rng.integers(0, levels, n) / levels


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(1)
    rows = [(g, float(v), int(rng.integers(0, 9))) for g in ("a", "b", None) for v in rng.permutation(100)]
    frame = spark.createDataFrame(rows, "g string, v double, n bigint")
    got = running_totals(frame, "v", ["n"], ["g"], descending)
    assert got.count() == 300
    for r in got.collect():
        mine = [x for x in rows if x[0] == r.g]
        assert r.cum_n == sum(n for _, v, n in mine if (v >= r.v if descending else v <= r.v))
        assert r.total_n == sum(n for _, _, n in mine)


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_percentiles_equal_numpy(spark, n):
    values = np.random.default_rng(n).integers(0, 12, n).astype(float)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = percentiles(frame, "v", {"a": 0.2, "b": 0.5, "c": 0.8}).first()
    assert list(got) == pytest.approx(list(np.percentile(values, [20, 50, 80])))


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])


def brute_curve(y, p):
    points = []
    for cut in sorted(set(p)):
        tp = ((p >= cut) & (y == 1)).sum()
        points.append((cut, tp / (p >= cut).sum(), tp / (y == 1).sum()))
    return points


@pytest.mark.parametrize("seed", [0, 1])
def test_curve_metrics_against_brute_force(spark, seed):
    y, p = random_scores(seed)
    scored = scored_frame(spark, y, p)
    curve = brute_curve(y, p)
    got = metrics.pr_curve(scored).orderBy(F.asc_nulls_last("threshold")).collect()
    assert [tuple(r) for r in got[:-1]] == [pytest.approx(c) for c in curve]
    assert tuple(got[-1]) == (None, 1.0, 0.0)
    ranked = metrics.ranking_metrics(scored).first()
    assert ranked.roc_auc == pytest.approx(brute_auc(y, p))
    steps = [(r, q) for _, q, r in reversed(curve)]
    ap = sum((r - before) * q for (r, q), before in zip(steps, [0.0, *[s[0] for s in steps]]))
    assert ranked.avg_precision == pytest.approx(ap)


def test_degenerate_scores(spark):
    flat = metrics.ranking_metrics(scored_frame(spark, [0, 1, 1], [0.5, 0.5, 0.5])).first()
    assert flat.roc_auc == 0.5
    one_class = metrics.evaluate(scored_frame(spark, [0, 0], [0.1, 0.9]).withColumn("model", F.lit("m"))).first()
    assert one_class.roc_auc is None and one_class.avg_precision is None
    none_predicted = metrics.rates(scored_frame(spark, [1, 0], [0.1, 0.2])).first()
    assert (none_predicted.precision, none_predicted.recall, none_predicted.f1) == (0.0, 0.0, 0.0)


def test_confusion_and_report(spark):
    scored = scored_frame(spark, [1, 1, 1, 0, 0], [0.9, 0.8, 0.1, 0.7, 0.2])
    assert {(r.y, r.pred): r.n for r in metrics.confusion(scored).collect()} == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    report = {r["class"]: r for r in metrics.class_report(scored).collect()}
    assert report["spam"].precision == pytest.approx(2 / 3) and report["ham"].recall == 0.5
    assert report["accuracy"].f1 == pytest.approx(0.6) and report["weighted avg"].support == 5
    assert metrics.spam_recall(scored).first()[0] == pytest.approx(2 / 3)
    assert metrics.ham_precision(scored).first()[0] == 0.5


@pytest.mark.parametrize("metric", ["f1", "precision", "recall"])
def test_best_threshold_is_the_first_maximum(spark, metric):
    y, p = random_scores(3)
    curve = brute_curve(y, p) + [(0.5, 1.0, 0.0)]
    score = {
        "f1": lambda q, r: 2 * q * r / (q + r + 1e-10),
        "precision": lambda q, r: q,
        "recall": lambda q, r: r,
    }[metric]
    values = [score(q, r) for _, q, r in curve]
    at = int(np.argmax(values))
    got = thresholds.best_threshold(scored_frame(spark, y, p), metric).first()
    assert tuple(got) == pytest.approx((curve[at][0], values[at]))


def test_threshold_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown metric"):
        thresholds.best_threshold(scored_frame(spark, [1], [0.5]), "auc")
    with pytest.raises(ValueError, match="nothing to write|No thresholds"):
        thresholds.ThresholdOptimizer().save_thresholds(spark, str(tmp_path / "t"))


def test_high_recall_threshold(spark):
    y, p = random_scores(4)
    curve = [c for c in brute_curve(y, p) if c[2] >= 0.9]
    best = max(curve, key=lambda c: (c[1], -c[0]))
    assert tuple(thresholds.high_recall_threshold(scored_frame(spark, y, p), 0.9).first()) == pytest.approx(best)
    assert thresholds.high_recall_threshold(scored_frame(spark, y, p), 1.1).first().threshold is None


def test_cascade_thresholds(spark, tmp_path):
    y, p = random_scores(5)
    tuner = thresholds.ThresholdOptimizer()
    got = tuner.find_cascade_thresholds(scored_frame(spark, y, p))
    low, high = np.percentile(p[y == 0], 20), np.percentile(p[y == 1], 80)
    assert got["stage1_low_threshold"] == pytest.approx(low) and got["stage1_high_threshold"] == pytest.approx(high)
    assert got["stage1_coverage"] == pytest.approx(1 - ((p > low) & (p < high)).mean())
    tuner.save_thresholds(spark, str(tmp_path / "t"))
    assert spark.read.json(str(tmp_path / "t")).first().stage2_threshold == 0.5


def test_target_thresholds_honour_both_targets(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 500)
    p = np.round(np.clip(y * 0.3 + rng.random(500) * 0.7, 0, 1), 3)
    got = thresholds.cascade_thresholds_target(scored_frame(spark, y, p), 0.8, 1.0).first()
    assert not ((p <= got.stage1_low_threshold) & (y == 1)).any()
    assert got.stage1_coverage >= 0.8


def test_leaderboard_order_and_best(spark):
    rows = [("b", 1, 1), ("b", 0, 0), ("a", 1, 1), ("a", 0, 0), ("c", 1, 0), ("c", 0, 1)]
    board = leaderboard(spark.createDataFrame(rows, "model string, y int, pred int"))
    assert [r.model for r in board.collect()] == ["a", "b", "c"]
    assert tuple(best_model(board).first()) == ("a", 1.0)
    assert top_models(board, 2).columns[0] == "model" and top_models(board, 2).count() == 2
    with pytest.raises(ValueError, match="Unknown metric"):
        best_model(board, "auc")
    assert not math.isnan(board.first().balanced_accuracy)


def test_a_missing_prediction_is_an_error(spark):
    frame = spark.createDataFrame([(1, 1), (0, None)], "y int, pred int")
    with pytest.raises(Exception, match="no prediction"):
        metrics.rates(frame).collect()
