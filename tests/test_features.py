from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.contract import FEATURE_COLUMNS, Contract
from tidemark.operators import features as fx

T0 = datetime(2024, 1, 1)


def sensors(spark, readings):
    rows = [(m, T0 + timedelta(hours=i), float(x), float(x) / 2, float(x) + 1)
            for m, xs in readings.items() for i, x in enumerate(xs)]
    schema = "machine_id string, event_timestamp timestamp_ntz, temperature double, vibration double, current double"
    return spark.createDataFrame(rows, schema)


def column(df, name):
    ordered = df.orderBy("machine_id", "event_timestamp")
    return [r[name] for r in ordered.collect()]


def test_windows_stay_inside_an_entity(spark):
    df = sensors(spark, {"m1": [10, 20], "m2": [100, 200]})
    leaky = fx.Feature("r", "temperature", "mean", 3, shifted=False)
    assert column(fx.build_features(df, [leaky]), "r") == [10, 15, 100, 150]


def test_unshifted_window_values(spark):
    df = sensors(spark, {"m1": [2, 4, 6, 8]})
    leaky = fx.Feature("r", "temperature", "mean", 2, shifted=False)
    assert column(fx.build_features(df, [leaky]), "r") == [2, 3, 5, 7]


def test_sensor_features_look_back_only(spark):
    made = fx.build_features(sensors(spark, {"m1": [10, 20, 40]}), fx.sensor_features(3))
    assert column(made, "temp_roll_mean") == [0, 10, 15]
    assert column(made, "vib_roll_std") == [0, 0, pytest.approx(3.5355339)]
    assert column(made, "temp_delta") == [0, 10, 20]


def test_contract_of_the_output(spark):
    df = sensors(spark, {"m1": [1, 5, 2, 8], "m2": [4, 4, 4, 4]})
    made = fx.build_features(df, fx.sensor_features(3))
    assert made.count() == df.count()
    assert set(df.columns) | set(FEATURE_COLUMNS) == set(made.columns)
    assert made.where(" or ".join(f"{c} is null" for c in FEATURE_COLUMNS)).isEmpty()
    assert made.where("vib_roll_std < 0").isEmpty()


def test_missing_source_is_an_error(spark):
    with pytest.raises(KeyError):
        fx.build_features(sensors(spark, {"m": [1]}).drop("current"), fx.sensor_features(3))


def test_a_later_reading_changes_nothing_before_it(spark):
    df = sensors(spark, {"m1": [3, 9, 4, 7, 1, 6]})
    late = F.col("event_timestamp") >= F.lit(T0 + timedelta(hours=3))
    changed = df.withColumn("temperature", F.when(late, 999.0).otherwise(F.col("temperature")))
    feature = [fx.Feature("m", "temperature", "mean", 3), fx.Feature("d", "temperature", "delta", strict=True)]
    a, b = (fx.build_features(d, feature).where(F.col("event_timestamp") <= F.lit(T0 + timedelta(hours=3)))
            for d in (df, changed))
    assert a.drop("temperature").exceptAll(b.drop("temperature")).isEmpty()


def test_history_restarts_at_a_split(spark):
    df = sensors(spark, {"m1": [1, 2, 3, 4]}).withColumn(
        "split", F.when(F.col("temperature") <= 2, "train").otherwise("test")
    )
    feature = [fx.Feature("m", "temperature", "mean", 3)]
    assert column(fx.build_features(df, feature, reset_at=["split"]), "m") == [0, 1, 0, 3]


def test_supervised_windows(spark):
    df = sensors(spark, {"m1": range(6), "m2": range(2)})
    made = fx.supervised_windows(df, "temperature", 3, 2).orderBy("event_timestamp").collect()
    assert [(r["inputs"], r["targets"]) for r in made] == [([0, 1, 2], [3, 4]), ([1, 2, 3], [4, 5])]
    with pytest.raises(ValueError):
        fx.supervised_windows(df, "temperature", 0, 1)


def test_head_per_entity_and_leak_compare(spark):
    df = sensors(spark, {"m1": [5, 6, 7], "m2": [1]})
    assert fx.head_per_entity(df, 2).count() == 3
    both = fx.leak_compare(df, ["temperature"], 2).orderBy("event_timestamp").collect()
    assert [(r["temperature__leak"], r["temperature__ok"]) for r in both] == [(6, 5), (7, 5.5)]


def test_composite_entity(spark):
    df = sensors(spark, {"m1": [1, 2]}).withColumn("line", F.col("temperature").cast("int") % 2)
    key = Contract(("machine_id", "line"))
    made = fx.build_features(df, [fx.Feature("m", "temperature", "mean", 2)], key)
    assert column(made, "m") == [0, 0]
