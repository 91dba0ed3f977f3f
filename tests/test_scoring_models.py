import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemark.operators import models as md
from tidemark.operators import scoring as sc
from tidemark.operators.evaluation import ranking_metrics


def logits(spark, *values):
    return spark.createDataFrame([(list(map(float, v)),) for v in values], "z array<float>")


def test_defect_probability(spark):
    got = sc.defect_decision(logits(spark, [-5, 5], [5, -5], [0, 0], [0], [1000, 0]), F.col("z")).collect()
    assert got[0]["defect_probability"] > 0.99 and got[0]["decision"] == "defect"
    assert got[1]["defect_probability"] < 0.01 and got[1]["decision"] == "good"
    assert got[2]["decision"] == got[3]["decision"] == "defect"  # the threshold is inclusive
    assert got[4]["defect_probability"] == 0


def test_channels(spark):
    df = spark.createDataFrame([("ok", [255.0, 0.0, 127.5] * 4), ("short", [1.0] * 11)], "id string, px array<double>")
    got = sc.normalize_channels(df, F.col("px"), 2, 2).collect()
    assert [r["id"] for r in got] == ["ok"]
    red, green, blue = got[0]["channels"]
    assert red == pytest.approx([(1 - 0.485) / 0.229] * 4)
    assert green == pytest.approx([-0.456 / 0.224] * 4)
    assert blue == pytest.approx([(0.5 - 0.406) / 0.225] * 4)


def test_classify(spark):
    got = sc.classify(logits(spark, [0, 3, 1]), F.col("z"), ["a", "b", "c"]).first()
    assert (got["class_id"], got["class_name"]) == (1, "b")
    assert sum(got["probabilities"].values()) == pytest.approx(1)


def test_feature_vector_order_and_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "current double, temperature double, vibration double")
    assert sc.feature_vector(df).first()["features"] == [2, 3, 1]
    with pytest.raises(ValueError):
        sc.feature_vector(df.drop("current"))


@pytest.fixture(scope="module")
def readings(spark):
    draw = random.Random(7)
    rows = []
    for i in range(300):
        t = draw.gauss(50, 10)
        rows.append((f"m{i % 5}", i, t, draw.random(), draw.random(), int(t + draw.gauss(0, 4) > 55)))
    return spark.createDataFrame(rows, "machine_id string, i int, temperature double, vibration double, current double, failure int")


def test_trees_learn_and_survive_a_save(spark, readings, tmp_path):
    params = {**md.LIGHT_TREE_PARAMS, "maxIter": 5}
    model = md.fit(readings, md.estimator("trees", params=params), ["temperature"], "failure")
    md.save(model, str(tmp_path / "m"))
    a, b = (sc.score_readings(m, readings, ["i"]) for m in (model, md.load(str(tmp_path / "m"))))
    assert a.exceptAll(b).isEmpty()
    scored = a.join(readings.select("i", "failure"), "i")
    assert ranking_metrics(scored, "failure", "failure_probability").first()["roc_auc"] > 0.9
    with pytest.raises(ValueError):
        md.fit(readings.drop("current"), md.estimator("trees"), ["current"], "failure")
    with pytest.raises(ValueError):
        md.estimator("unknown")


def test_predictions_stay_with_their_request_and_order(spark, readings):
    model = md.fit(readings, md.estimator("trees", params={**md.LIGHT_TREE_PARAMS, "maxIter": 2}), ["temperature"], "failure")
    item = F.struct("machine_id", "temperature", "vibration", "current")
    requests = readings.groupBy((F.col("i") % 7).alias("r")).agg(F.collect_list(item).alias("readings"))
    scored = sc.score_readings(model, sc.explode_requests(requests, "r"), ["r", "position", "machine_id"])
    answers = sc.gather_responses(scored, "r", "machine_id").join(requests, "r").collect()
    for a in answers:
        assert [p["machine_id"] for p in a["predictions"]] == [x["machine_id"] for x in a["readings"]]


def test_forecasts(spark):
    rows = [([float(i), i + 1.0, i + 2.0, i + 3.0], [i + 4.0, i + 5.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "inputs array<double>, targets array<double>")
    assert md.naive_forecast(df, 2).first()["forecast"] == [3, 3]
    assert md.seasonal_forecast(df, 2, 2).first()["forecast"] == [2, 3]
    model = md.LinearForecaster.fit(df, 2, regularisation=1e-9)
    for r in model.transform(df).collect():
        assert r["forecast"] == pytest.approx(r["targets"], abs=1e-3)


def test_space_sampling():
    space = {"lr": {"type": "float", "low": 0.01, "high": 0.3, "log": True}, "n": {"type": "int", "low": 100, "high": 600, "step": 50},
             "o": {"type": "categorical", "choices": ["a", "b"]}}
    made = md.sample_space(space, 50)
    assert made == md.sample_space(space, 50)
    assert all(0.01 <= s["lr"] <= 0.3 and (s["n"] - 100) % 50 == 0 and s["n"] <= 600 and s["o"] in "ab" for s in made)
    with pytest.raises(ValueError):
        md.sample_space({"x": {"type": "other"}}, 1)


def test_search_keeps_the_best(spark, readings):
    pipeline = md.estimator("logistic", features=["temperature", "vibration"], label="failure")
    results, best = md.search(readings, pipeline, [{"regParam": 0.01}, {"regParam": 50.0}], "failure")
    table = md.trial_table(spark, results)
    assert table.count() == 2 and best.transform(readings).count() == 300


def test_search_by_own_metrics(spark, readings):
    pipeline = md.estimator("logistic", features=["temperature", "vibration"], label="failure")
    settings = [{"regParam": 0.01}, {"regParam": 0.5}]
    for metric in ("aucpr", "f1"):
        results, _ = md.search(readings, pipeline, settings, "failure", metric=metric)
        assert all(0 <= value <= 1 for _, value in results)
    model = pipeline.fit(readings)
    by_hand = md.holdout_report(model, readings, "failure").first()
    assert md.TableMetric("aucpr", "failure").evaluate(model.transform(readings)) == by_hand["aucpr"]


def test_search_by_rmse_takes_the_least(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 1) for x in range(60)], "x double, y double")
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y")])
    results, best = md.search(df, pipeline, [{"regParam": 0.0}, {"regParam": 500.0}], "y", metric="rmse", folds=3)
    assert results[0][1] < 1e-6 < results[1][1]
    assert best.stages[-1].coefficients[0] == pytest.approx(3.0)
