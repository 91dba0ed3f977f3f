import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import flows
from tidemark.contract import FEATURE_COLUMNS
from tidemark.operators.quality import DataValidationError

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sensors(spark):
    """Five machines, hourly readings; failures follow the temperature. One row comes twice."""
    draw = random.Random(42)
    rows = []
    for m in range(5):
        for i in range(120):
            t = draw.gauss(60 + m, 8)
            rows.append((f"machine_{m}", T0 + timedelta(hours=i), t, draw.random(), 5 + draw.random(), int(t + draw.gauss(0, 2) > 68)))
    rows.append(rows[0])
    schema = "machine_id string, event_timestamp timestamp_ntz, temperature double, vibration double, current double, failure int"
    return spark.createDataFrame(rows, schema)


def test_features_to_gated_model(spark, sensors, tmp_path):
    table = flows.feature_flow(sensors, str(tmp_path / "features"))
    assert table.count() == sensors.count() - 1
    assert set(FEATURE_COLUMNS) <= set(table.columns)
    done = flows.training_flow(table, params={"maxIter": 5, "maxDepth": 3})
    metrics = {r["metric"]: r["value"] for r in done.metrics.collect()}
    assert metrics["roc_auc"] > 0.8
    gate = done.gate.first()
    assert gate["metric"] == "f1" and gate["passed"] == (metrics["f1"] >= 0.7)


def test_bad_log_stops_the_flow(sensors, tmp_path):
    with pytest.raises(DataValidationError):
        flows.feature_flow(sensors.withColumn("failure", F.lit(3)), str(tmp_path / "x"))


def test_rollout(spark):
    probes = spark.createDataFrame([("v2", "ok")] * 5, "target string, status string")
    assert flows.rollout(probes, probes).first()["decision"] == "promote"
