import random

import pytest

from tidemark.operators import evaluation as ev


def scored(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def test_perfect_scores(spark):
    got = ev.classification_report(scored(spark, [0, 0, 1, 1, 0, 1], [0.01, 0.1, 0.99, 0.95, 0.05, 0.9]), "y", "p").first()
    assert got["roc_auc"] == got["aucpr"] == got["f1"] == got["accuracy"] == 1


def test_random_scores_are_near_half(spark):
    draw = random.Random(0)
    df = scored(spark, [draw.random() < 0.3 for _ in range(5000)], [draw.random() for _ in range(5000)])
    assert abs(ev.ranking_metrics(df, "y", "p").first()["roc_auc"] - 0.5) < 0.05


def test_better_ranking_has_better_average_precision(spark):
    y = [1, 0, 0, 1, 0, 0, 0, 1]
    good, bad = [0.9, 0.2, 0.1, 0.8, 0.3, 0.2, 0.1, 0.7], [0.1, 0.8, 0.9, 0.2, 0.7, 0.8, 0.9, 0.3]
    a, b = (ev.ranking_metrics(scored(spark, y, p), "y", "p").first()["aucpr"] for p in (good, bad))
    assert a > b


def test_ties_against_brute_force(spark):
    draw = random.Random(5)
    y = [draw.randrange(2) for _ in range(200)]
    p = [draw.randrange(8) / 8 for _ in range(200)]
    pos, neg = [b for a, b in zip(y, p) if a], [b for a, b in zip(y, p) if not a]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    ap, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(1 for b in pos if b >= t)
        ap += (tp / len(pos) - before) * tp / sum(1 for b in p if b >= t)
        before = tp / len(pos)
    got = ev.ranking_metrics(scored(spark, y, p), "y", "p").first()
    assert got["roc_auc"] == pytest.approx(auc) and got["aucpr"] == pytest.approx(ap)


def test_one_class_has_no_area(spark):
    got = ev.classification_report(scored(spark, [1, 1], [0.2, 0.9]), "y", "p").first()
    assert got["roc_auc"] is None and got["aucpr"] is None and got["recall"] == 0.5


def test_f1_identity_and_zero_division(spark):
    df = spark.createDataFrame(list(zip([1, 1, 1, 1, 1, 0], [1, 1, 1, 1, 0, 1])), "y int, h int")
    got = ev.binary_metrics(df, "y", "h").first()
    assert got["precision"] == got["recall"] == pytest.approx(0.8) and got["f1"] == pytest.approx(0.8)
    none = spark.createDataFrame([(0, 0)], "y int, h int")
    got = ev.binary_metrics(none, "y", "h").first()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0, 0, 0, 1)


@pytest.mark.parametrize("value, passed", [(0.95, True), (0.9, True), (0.2, False)])
def test_gate(spark, value, passed):
    metrics = spark.createDataFrame([("f1", value)], "metric string, value double")
    assert ev.quality_gate(metrics, "f1", 0.9).first()["passed"] is passed


def test_gate_direction_missing_and_nan(spark):
    metrics = spark.createDataFrame([("rmse", 1.5), ("auc", float("nan"))], "metric string, value double")
    low = ev.quality_gate(metrics, *ev.FORECAST_GATE).first()
    assert low["passed"] is True and low["direction"] == "minimize"
    assert ev.quality_gate(metrics, "f1", 0.1).first()["passed"] is False
    assert ev.quality_gate(metrics, "auc", 0.1).first()["passed"] is False


def test_threshold_is_inclusive(spark):
    assert ev.threshold_flag(scored(spark, [1], [0.5]), "p", 0.5).first()["predicted"] == 1


def test_horizon_arrays_are_flattened(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 4.0])], "a array<double>, b array<double>")
    got = ev.regression_metrics(df, "a", "b").first()
    assert got["mse"] == 2 and got["mae"] == 1


def test_report_file(spark, tmp_path):
    metrics = spark.createDataFrame([("f1", 0.8)], "metric string, value double")
    ev.write_report(metrics, ev.quality_gate(metrics), str(tmp_path / "r"))
    got = spark.read.json(str(tmp_path / "r")).first()
    assert got["f1"] == 0.8 and got["gate_passed"] == 1.0
