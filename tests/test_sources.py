from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.sources import tables as tb
from tidemark.sources import versions as vs

T0 = datetime(2024, 1, 1)


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "sensors.csv"
    path.write_text(
        "machine_id,event_timestamp,temperature,vibration,current,failure\n"
        "m1,2024-01-01 00:00:00,20.5,1.0,3.0,0\nm1,2024-01-03 01:00:00,NaN,1.1,3.1,1\n"
    )
    return str(path)


def test_source_precedence_and_types(spark, csv, tmp_path):
    df = tb.read_sensors(spark, {"data": {"source": "/nowhere.csv"}}, source=csv)
    assert df.schema == tb.SENSOR_SCHEMA
    assert df.where("temperature is null").count() == 1
    assert tb.read_sensors(spark, {"source": "/nowhere.csv"}, fallback=csv).count() == 2
    with pytest.raises(FileNotFoundError):
        tb.read_sensors(spark, source=str(tmp_path / "absent"))


def test_demand_fills_empty_days(spark, csv):
    days = tb.read_demand(spark, {"source": csv}).orderBy("event_timestamp").collect()
    assert [(r["event_timestamp"], r["demand"]) for r in days] == [
        (T0, 1), (T0 + timedelta(days=1), 0), (T0 + timedelta(days=2), 1)
    ]


def test_manifest_from_folders(spark, tmp_path):
    for name in ("train/good/a.png", "test/crack/b.JPG", "good/c.bmp", "d.png", "test/good/notes.txt"):
        path = tmp_path / "images" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    got = {r["image_path"].rsplit("/", 1)[1]: (r["split"], r["label"]) for r in tb.read_manifest(spark, str(tmp_path / "images")).collect()}
    assert got == {"a.png": ("train", "good"), "b.JPG": ("test", "crack"), "c.bmp": ("unknown", "good"), "d.png": ("unknown", "unknown")}
    empty = tb.read_manifest(spark, str(tmp_path / "none"))
    assert empty.columns == ["image_path", "label", "split"] and empty.isEmpty()


def test_cycles_become_hours(spark, tmp_path):
    path = tmp_path / "cycles.txt"
    path.write_text("1 1 0.5 20.1 \n1 2 0.6 20.2 \n\n")
    df = tb.read_cycles(spark, str(path), ["unit_number", "time_cycles", "s1", "s2"], T0)
    assert [(r["machine_id"], r["event_timestamp"], r["s2"]) for r in df.orderBy("time_cycles").collect()] == [
        ("1", T0 + timedelta(hours=1), 20.1), ("1", T0 + timedelta(hours=2), 20.2)
    ]


def test_outputs_are_partitioned_and_raw_is_kept(spark, csv, tmp_path):
    df = tb.read_sensors(spark, source=csv)
    tb.write_splits(df.withColumn("split", F.lit("train")), str(tmp_path / "splits"))
    assert (tmp_path / "splits" / "split=train").exists()
    tb.write_feature_table(df, str(tmp_path / "features"))
    assert (tmp_path / "features" / "event_date=2024-01-03").exists()
    tb.write_sorted(df, str(tmp_path / "sorted"))
    assert spark.read.parquet(str(tmp_path / "sorted")).count() == 2
    tb.write_layer(df, str(tmp_path), "raw", "s")
    with pytest.raises(AnalysisException):
        tb.write_layer(df, str(tmp_path), "raw", "s")
    tb.write_layer(df, str(tmp_path), "interim", "s")
    tb.write_layer(df, str(tmp_path), "interim", "s")
    with pytest.raises(ValueError):
        tb.layer_path("x", "other", "s")


def test_fingerprint_ignores_order_but_not_content(spark):
    rows = [(1, "a"), (2, None), (2, None), (3, "")]
    one = spark.createDataFrame(rows, "x int, y string")
    two = spark.createDataFrame(rows[::-1], "x int, y string").repartition(3)
    version = lambda d: vs.fingerprint(d).first()["version"]
    assert version(one) == version(two)
    assert version(one) != version(one.distinct())
    assert version(one) != version(one.fillna(""))
    assert vs.fingerprint(one.limit(0)).first()["n_rows"] == 0


def test_versions_can_be_restored(spark, tmp_path):
    one = spark.range(5)
    first = vs.save_version(one, str(tmp_path))
    second = vs.save_version(spark.range(3, 7), str(tmp_path))
    assert vs.save_version(one, str(tmp_path)) == first != second
    old, new = (vs.load_version(spark, str(tmp_path), v) for v in (first, second))
    assert {(r["id"], r["change"]) for r in vs.diff(old, new).collect()} == {
        (5, "added"), (6, "added"), (0, "removed"), (1, "removed"), (2, "removed")
    }
    assert vs.unchanged(old, new).count() == 2
