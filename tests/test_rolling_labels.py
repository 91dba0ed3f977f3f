"""Drift of the last hours from counts, and late labels."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as dr
from tidemark.operators import rolling as ro
from tidemark.streaming import jobs
from tidemark.streaming.labels import label_feedback

T0 = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)


def log_of(spark, n, seed, start=0, step=7):
    rng = random.Random(seed)
    rows = [(T0 + timedelta(minutes=start + step * i), rng.choice([None, float("nan"), *([float(rng.randrange(40))] * 8)]),
             rng.randrange(5)) for i in range(n)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, x double, y int")


def test_each_tick_equals_the_two_sample_test_on_its_rows(spark):
    reference, log = log_of(spark, 300, 1), log_of(spark, 400, 2, start=3000)
    grids = ro.reference_grids(reference, ["x", "y"])
    got = {(r.feature, r.tick): r for r in ro.rolling_drift(log, grids, 6 * HOUR, HOUR).collect()}
    ticks = sorted({t for _, t in got})
    assert len(ticks) > 40
    for tick in ticks[:: len(ticks) // 4]:
        now = log.where((F.col("ts") >= F.lit(tick - 6 * HOUR).cast("timestamp_ntz")) & (F.col("ts") < F.lit(tick).cast("timestamp_ntz")))
        sides = dr.stack_sides(reference, now, ["x", "y"])
        for want in dr.ks_drift(sides, ["x", "y"]).collect():
            r = got[want.feature, tick]
            assert (r.n_ref, r.n_cur) == (want.n_ref, want.n_cur)
            assert r.statistic == pytest.approx(want.statistic) and r.p_value == pytest.approx(want.p_value)


def test_coarse_grid_stays_within_its_bound(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(size=5000), rng.normal(0.4, 1.2, 3000)
    reference = spark.createDataFrame([(T0, float(v)) for v in ref], "ts timestamp_ntz, x double")
    log = spark.createDataFrame([(T0, float(v)) for v in cur], "ts timestamp_ntz, x double")
    exact = ro.rolling_drift(log, ro.reference_grids(reference, ["x"], 10_000), HOUR, HOUR).first().statistic
    coarse = ro.reference_grids(reference, ["x"], 100)
    assert 100 <= len(coarse["x"].values) <= 101
    found = ro.rolling_drift(log, coarse, HOUR, HOUR).first().statistic
    assert exact - 0.01 <= found <= exact + 1e-12


def test_no_values_and_no_rows(spark):
    empty = log_of(spark, 5, 1).where("false")
    grids = ro.reference_grids(empty, ["x"])
    assert ro.rolling_drift(log_of(spark, 20, 1), grids).count() == 0
    assert ro.rolling_drift(empty, ro.reference_grids(log_of(spark, 20, 1), ["x"])).count() == 0


def test_rolling_stream_over_files_and_a_gap(spark, tmp_path):
    reference = log_of(spark, 300, 1)
    log = log_of(spark, 200, 2).unionByName(log_of(spark, 100, 3, start=6000))
    for i, (low, high) in enumerate(((0, 900), (900, 5000), (5000, 9000))):
        at = lambda m: F.lit(T0 + timedelta(minutes=m)).cast("timestamp_ntz")
        log.where((F.col("ts") >= at(low)) & (F.col("ts") < at(high))).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    grids = ro.reference_grids(reference, ["x", "y"])
    stream = jobs.file_stream(spark, str(tmp_path / "t"), log.schema, files_per_trigger=1)
    ending = jobs.Ending(stream, T0 + timedelta(days=7))
    got = jobs.run_to_table(ro.rolling_drift_stream(ending.watermarked(stream), grids, 4 * HOUR, HOUR), "rolling", ending)
    want = ro.rolling_drift(log, grids, 4 * HOUR, HOUR)
    show = lambda df: sorted(
        (r.feature, r.tick, r.n_ref, r.n_cur, round(r.statistic, 12), round(r.p_value, 12), r.drifted) for r in df.collect())
    assert show(got) == show(want)


PREDICTIONS, LABELS = "id int, k string, ts timestamp_ntz", "k string, ts timestamp_ntz"


def feedback_rows():
    at = lambda h: T0 + h * HOUR
    made = [(1, "a", at(0)), (2, "a", at(10)), (3, "b", at(1)), (4, None, at(1)), (1, "a", at(0)), (5, "c", at(2)), (6, "a", at(30))]
    late = [("a", at(5)), ("a", at(6)), ("a", at(34)), ("b", at(0)), (None, at(2)), ("c", at(26))]
    return made, late, {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1}


def test_label_feedback_in_batch(spark):
    made, late, want = feedback_rows()
    got = label_feedback(spark.createDataFrame(made, PREDICTIONS), spark.createDataFrame(late, LABELS), ["k"], ["id"], 24 * HOUR)
    assert sorted((r.id, r.label) for r in got.collect()) == sorted(want.items())  # a day exactly still counts


def test_label_feedback_as_streams(spark, tmp_path):
    made, late, want = feedback_rows()
    for hours in (range(0, 15), range(15, 40)):
        inside = lambda t: int((t - T0) / HOUR) in hours
        spark.createDataFrame([r for r in made if inside(r[2])], PREDICTIONS).coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
        spark.createDataFrame([r for r in late if inside(r[1])], LABELS).coalesce(1).write.mode("append").parquet(str(tmp_path / "l"))
    sides = [
        jobs.file_stream(spark, str(tmp_path / n), spark.createDataFrame([], s).schema, files_per_trigger=1)
        for n, s in (("p", PREDICTIONS), ("l", LABELS))
    ]
    endings = [jobs.Ending(s, T0 + 60 * HOUR) for s in sides]
    joined = label_feedback(
        endings[0].watermarked(sides[0]), endings[1].watermarked(sides[1]), ["k"], ["id"], 24 * HOUR, delay=None, label_delay=None)
    got = jobs.run_to_table(joined, "labelled", *endings)
    assert sorted((r.id, r.label) for r in got.collect()) == sorted(want.items())
