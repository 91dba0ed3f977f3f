from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import quality as q

T0 = datetime(2024, 1, 1)
SCHEMA = "machine_id string, event_timestamp timestamp_ntz, temperature double, vibration double, current double, failure int"


def good(spark):
    return spark.createDataFrame([("m1", T0 + timedelta(hours=i), 20.0 + i, 1.0, 3.0, i % 2) for i in range(4)], SCHEMA)


def test_good_table_passes(spark):
    df = good(spark)
    assert q.validate_sensors(df) is df


@pytest.mark.parametrize(
    "column, value, said",
    [("failure", 7, "in_set(failure)"), ("temperature", 251.0, "in_range(temperature)"), ("current", None, "not_null(current)")],
)
def test_bad_value_is_named(spark, column, value, said):
    df = good(spark).withColumn(column, F.lit(value).cast(good(spark).schema[column].dataType))
    with pytest.raises(q.DataValidationError) as error:
        q.validate_sensors(df)
    assert said in str(error.value)


def test_empty_and_missing_columns(spark):
    with pytest.raises(q.DataValidationError, match="non_empty"):
        q.validate_sensors(good(spark).limit(0))
    with pytest.raises(q.DataValidationError, match="missing columns"):
        q.validate_sensors(good(spark).drop("vibration"))


def test_allow_nulls_and_own_ranges(spark):
    df = good(spark).withColumn("current", F.lit(None).cast("double"))
    q.validate_sensors(df, allow_nulls=True)
    with pytest.raises(q.DataValidationError):
        q.validate_sensors(good(spark), ranges={"temperature": (0.0, 10.0)})


def test_request_bounds_are_inclusive(spark):
    rows = [("a", -50.0, 0.0, 0.0), ("b", 500.0, 9e9, 1.0), ("c", 500.1, 0.0, 0.0), ("d", 1.0, -0.1, None), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "machine_id string, temperature double, vibration double, current double")
    ok, bad = q.quarantine(df, q.request_rules())
    assert {r["machine_id"] for r in ok.collect()} == {"a", "b"}
    reasons = {r["machine_id"]: r["reasons"] for r in bad.collect()}
    assert reasons["c"] == ["in_range:temperature"]
    assert reasons["d"] == ["not_null:current", "in_range:vibration"]


def test_batch_size_limits(spark):
    df = spark.range(1001).withColumn("r", F.lit("big")).unionByName(spark.range(1000).withColumn("r", F.lit("full")))
    assert {r["r"]: r["accepted"] for r in q.batch_sizes(df, ["r"]).collect()} == {"big": False, "full": True}


def test_dedup_keeps_the_first_by_tie(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 1, 2), ("b", 1, 5)], "k string, t int, id int")
    kept = q.dedup_first(df, Contract(("k",), "t", ("id",)))
    assert sorted((r["k"], r["id"]) for r in kept.collect()) == [("a", 2), ("b", 5)]


def test_label_rate_flags_one_class(spark):
    one = spark.createDataFrame([(1,), (1,)], "y int")
    assert q.label_rate(one, "y").first()["degenerate"] is True


def test_roles(spark):
    df = good(spark)
    assert q.feature_roles(df, "failure", ["machine_id"]) == ["temperature", "vibration", "current"]
    assert q.last_column_label(df)[1] == "failure"


def test_manifest_contract(spark):
    empty = spark.createDataFrame([], "image_path string, label string, split string")
    assert q.validate_manifest(empty) is empty
    with pytest.raises(q.DataValidationError):
        q.validate_manifest(empty, allow_empty=False)
    with pytest.raises(q.DataValidationError):
        q.validate_manifest(empty.drop("split"))
