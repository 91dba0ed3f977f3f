"""Inputs the given tables do not hold: missing values, ties of text, reordered files, silence."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import drift, models, monitoring, quality, runs, splits
from tidemark.operators.evaluation import calibration_bins
from tidemark.operators.store import Source, asof_join
from tidemark.sources import tables, versions

START = datetime(2024, 1, 1)
LOG = Contract(("machine_id",), "ts")


def test_sensor_csv_is_read_by_column_name(spark, tmp_path):
    path = tmp_path / "sensors.csv"
    path.write_text("failure,vibration,machine_id,extra,temperature,event_timestamp,current\n1,0.5,m1,x,70.0,2024-01-01 00:00:00,\n")
    row = tables.read_sensors(spark, source=str(path)).first()
    assert (row.machine_id, row.temperature, row.vibration, row.current, row.failure) == ("m1", 70.0, 0.5, None, 1)
    path.write_text("machine_id,temperature\nm1,70.0\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        tables.read_sensors(spark, source=str(path))


def test_manifest_of_a_root_whose_name_repeats(spark, tmp_path, monkeypatch):
    inner = tmp_path / "img" / "test" / "img"
    inner.mkdir(parents=True)
    (inner / "b.png").write_bytes(b"x")
    row = tables.read_manifest(spark, str(tmp_path / "img")).first()
    assert (row.split, row.label) == ("test", "img")


def test_fingerprint_has_no_simple_collisions_and_no_time_zone(spark):
    df = lambda *rows: spark.createDataFrame(list(rows), "a string, b string")
    version = lambda d: versions.fingerprint(d).first().version
    assert version(df(("a|=b", "c"))) != version(df(("a", "b|=c")))
    assert version(df((None, "c"))) != version(df(("~", "c")))
    assert version(df(("1", "2"))) != version(df(("1", "2")).withColumnRenamed("a", "z"))
    timed = spark.sql("SELECT timestamp '2024-01-01 00:00:00Z' AS t, 1.5D AS v")
    was = spark.conf.get("spark.sql.session.timeZone")
    first = version(timed)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert version(timed) == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_version_difference_counts_repeats(spark):
    df = lambda *rows: spark.createDataFrame([(r,) for r in rows], "a int")
    old, new = df(1, 1, 2, None), df(1, 2, 2, 2, None)
    assert sorted((r.a, r.change) for r in versions.diff(old, new).collect()) == [(1, "removed"), (2, "added"), (2, "added")]
    assert sorted(r.a or 0 for r in versions.unchanged(old, new).collect()) == [0, 1, 2]


def test_rows_without_a_time_get_no_split(spark):
    rows = [("m", START + timedelta(hours=i) if i < 8 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "machine_id string, ts timestamp_ntz")
    made = [r.split for r in splits.temporal_split(df, 0.2, contract=LOG).collect()]
    assert made.count("test") == 1 and made.count("train") == 7 and made.count(None) == 2
    sides = [r.side for r in splits.reference_current(df, [], LOG).collect()]
    assert sorted(sides) == ["current"] * 4 + ["reference"] * 4


@pytest.mark.parametrize("rows_per_task", ["3", "4000000"])
def test_text_entities_settle_equal_times(spark, rows_per_task):
    df = spark.createDataFrame([(f"machine-{i}", START) for i in range(10)], "machine_id string, ts timestamp_ntz")
    spark.conf.set("spark.tidemark.rowsPerTask", rows_per_task)
    try:
        made = splits.temporal_split(df, 0.3, contract=LOG).collect()
    finally:
        spark.conf.unset("spark.tidemark.rowsPerTask")
    assert sorted(r.machine_id for r in made if r.split == "test") == ["machine-7", "machine-8", "machine-9"]


def test_the_time_filter_of_a_split_reaches_the_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    log = Contract(("user_id",), "ts")
    whole = splits.temporal_split(events, 0.2, 0.1, log)
    for name, made in splits.temporal_sides(events, 0.2, 0.1, log).items():
        plan = made._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
        assert "Than(ts" in pushed[0].split("PushedFilters:")[1] or "ThanOrEqual(ts" in pushed[0]
        assert sorted(r.event_id for r in made.collect()) == sorted(
            r.event_id for r in whole.where(F.col("split") == name).collect())


def test_missing_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), "1"), (None, "x"), (5.0, None), (500.0, "0")], "x double, label string")
    count = lambda rule: df.where(rule.broken).count()
    assert count(quality.not_null("x")) == 2
    assert count(quality.in_range("x", 0, 100)) == count(quality.in_range("x", None, 100)) == 1
    assert count(quality.in_range("x", 10, None)) == 1
    assert count(quality.in_set("label", [0, 1])) == 1


def test_calibration_leaves_out_unscored_rows(spark):
    rows = [(1, 0.95), (0, None), (1, float("nan")), (None, 0.5), (0, 0.0)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert sorted((r.bin, r.n) for r in calibration_bins(df, "label", "score").collect()) == [(0, 1), (9, 1)]


@pytest.mark.parametrize("maximize, best, run", [(True, 0.9, "b"), (False, 0.2, "c")])
def test_best_child_has_the_metric(spark, maximize, best, run):
    kids = [("p", "a", {}), ("p", "b", {"m": 0.9}), ("p", "c", {"m": 0.2}), ("p", "d", {"m": 0.2}), ("p", "e", {"m": 0.9}),
            ("q", "f", {})]
    children = spark.createDataFrame(kids, "parent_id string, run_id string, metrics map<string,double>")
    parents = spark.createDataFrame([("p",), ("q",), ("r",)], "run_id string")
    got = {r.run_id: (r.n_children, r.best_m, r.best_run_id) for r in runs.with_children(parents, children, "m", maximize).collect()}
    assert got == {"p": (5, best, run), "q": (1, None, None), "r": (0, None, None)}


def test_importance_does_not_cancel(spark):
    rows = [(i % 4, 1e9 + (i % 4) * 1e-3 + (i % 3) * 1e-4) for i in range(120)]
    df = spark.createDataFrame(rows, "p int, value double")
    explained = runs.param_importance(df, {"p": F.col("p")}).first().explained
    assert 0.9 < explained <= 1


def test_number_and_text_columns_are_told_apart(spark):
    df = spark.createDataFrame([(1.0, "a", 2)], "x double, kind string, n int")
    assert drift.monitored_columns(df, df, contract=LOG, numeric=True) == ["x", "n"]
    assert drift.monitored_columns(df, df, contract=LOG, numeric=False) == ["kind"]


def test_a_missing_reading_does_not_stop_the_fit(spark):
    rows = [(float(i), None if i == 3 else float(i % 2), float(i > 10)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    model = models.fit(df, models.logistic_classifier(["a", "b"], "label"), ["a", "b"], "label")
    assert model.transform(df).where("prediction IS NULL").count() == 0


def test_forward_ties_take_the_first(spark):
    log = Contract(("machine_id",), "ts", ("seq",))
    spine = spark.createDataFrame([("m", START)], "machine_id string, ts timestamp_ntz")
    rows = [("m", START + timedelta(hours=1), s, float(s)) for s in (3, 1, 2)]
    later = spark.createDataFrame(rows, "machine_id string, ts timestamp_ntz, seq int, x double")
    assert asof_join(spine, [Source(later, log, ("x",))], LOG, direction="forward").first().x == 1.0


def test_the_last_reading_follows_the_tie(spark):
    log = Contract(("machine_id",), "ts", ("seq",))
    rows = [("m", START, s, float(s)) for s in (2, 9, 4)]
    df = spark.createDataFrame(rows, "machine_id string, ts timestamp_ntz, seq int, x double")
    assert quality.downsample(df, "x", "1 hour", log).first().last_value == 9.0


def test_an_outage_fires(spark):
    times = [START + timedelta(seconds=20 * i) for i in range(180)]  # an hour of traffic, 3.5 hours of silence, an hour
    times += [t + timedelta(hours=4, minutes=30) for t in times]
    log = spark.createDataFrame([(t, m, "ok", None, 0.1, 0.3) for t in times for m in ("a", "b")],
                                "ts timestamp_ntz, model string, status string, error_type string, latency_s double, prediction double")
    ticks = monitoring.qps(log).where("model = 'a'").orderBy("tick").collect()
    assert min(r.qps for r in ticks) == 0 and all(b.tick - a.tick == timedelta(seconds=30) for a, b in zip(ticks, ticks[1:]))
    raised = monitoring.alert_report(log).where("rule = 'InferenceTrafficDrop'").collect()
    assert sorted(r.model for r in raised) == ["a", "b"] and all(r.fired_at - r.since == timedelta(minutes=15) for r in raised)


def test_intermediate_tables_can_be_released(spark, monkeypatch):
    import os

    from tidemark.plans import scratch

    monkeypatch.setattr(scratch, "_made", [])
    path, made = scratch.written_to(spark.range(3).toDF("x"), "numbers")
    assert made.count() == 3 and os.path.exists(path)
    assert scratch.release(spark) == 1 and not os.path.exists(path)
