import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as dr
from tidemark.plans.distribution import exact_quantiles


def sides(spark, ref, cur):
    rows = [("reference", float(x)) for x in ref] + [("current", float(x)) for x in cur]
    return spark.createDataFrame(rows, "side string, x double")


def ks(ref, cur):
    ref, cur = np.sort(ref), np.sort(cur)
    at = np.concatenate([ref, cur])
    return np.abs(np.searchsorted(ref, at, "right") / len(ref) - np.searchsorted(cur, at, "right") / len(cur)).max()


def test_distances_against_numpy(spark):
    draw = random.Random(1)
    ref, cur = [round(draw.gauss(0, 1), 1) for _ in range(300)], [round(draw.gauss(0.3, 1.2), 1) for _ in range(250)]
    df = sides(spark, ref, cur)
    got = dr.ks_drift(df, ["x"]).first()
    d = ks(ref, cur)
    assert got["statistic"] == pytest.approx(d)
    root = math.sqrt(300 * 250 / 550)
    lam = (root + 0.12 + 0.11 / root) * d
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert got["p_value"] == pytest.approx(p) and got["drifted"] == (p < 0.05)
    grid = np.sort(np.concatenate([ref, cur]))
    f = lambda s: np.searchsorted(np.sort(s), grid[:-1], "right") / len(s)
    area = np.sum(np.abs(f(ref) - f(cur)) * np.diff(grid))
    assert dr.wasserstein(df, ["x"]).first()["wasserstein"] == pytest.approx(area)


def test_same_sides_do_not_drift(spark):
    got = dr.ks_drift(sides(spark, range(50), range(50)), ["x"]).first()
    assert got["statistic"] == 0 and got["p_value"] == 1 and got["drifted"] is False
    assert dr.psi(sides(spark, range(50), range(50)), ["x"]).first()["psi"] == pytest.approx(0)


def test_quarter_sigma_is_found_by_the_sweep(spark):
    draw = random.Random(4)
    df = sides(spark, [draw.gauss(0, 1) for _ in range(1500)], [draw.gauss(0, 1) for _ in range(1500)])
    got = {r["shift_sd"]: r["drifted"] for r in dr.drift_sweep(df, "x").collect()}
    assert got[0.0] is False and all(got[k] for k in dr.SWEEP if k >= 0.25)


def test_dataset_flag_needs_more_than_half(spark):
    flags = lambda *f: spark.createDataFrame([(x,) for x in f], "drifted boolean")
    assert dr.dataset_drift(flags(True, False)).first()["dataset_drift"] is False
    assert dr.dataset_drift(flags(True, True, False)).first()["dataset_drift"] is True


def test_columns(spark):
    df = spark.createDataFrame([("m", 1.0, 2.0, 0)], "machine_id string, a double, b double, failure int")
    assert dr.monitored_columns(df, df.drop("b")) == ["a"]
    with pytest.raises(ValueError):
        dr.monitored_columns(df.select("machine_id"), df)


def test_quantiles_against_numpy(spark):
    draw = random.Random(2)
    values = [draw.choice([1.0, 2.5, 7.0, 9.25]) if draw.random() < 0.5 else draw.random() for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [0, 0.1, 0.5, 0.99, 1]).first()
    assert [got[f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(values, [0, 0.1, 0.5, 0.99, 1])))


def test_alert_needs_consecutive_days(spark):
    rows = [("a", date(2024, 1, d), d in (2, 3, 4, 7, 8)) for d in range(1, 10)]
    df = spark.createDataFrame(rows, "k string, day date, hot boolean")
    got = dr.consecutive_alert(df, ["k"], "day", "hot", 3).collect()
    assert [(r["first_day"], r["last_day"], r["n_days"]) for r in got] == [(date(2024, 1, 2), date(2024, 1, 4), 3)]


def test_injection(spark):
    df = spark.createDataFrame([(2.0,)], "x double")
    assert dr.inject_drift(df, "x", 8.0, 1.5).first()["x"] == 11.0
    assert dr.inject_drift(df, "x", F.lit(1.0)).first()["x"] == 3.0


def test_report_has_all_distances_and_reads_once(spark):
    draw = random.Random(5)
    df = sides(spark, [round(draw.gauss(0, 1), 2) for _ in range(400)], [round(draw.gauss(0.5, 1), 2) for _ in range(300)])
    df = df.withColumn("y", F.when(F.col("side") == "reference", 1.0))  # no value on the current side
    got = {r["feature"]: r for r in dr.drift_report(df, ["x", "y"]).collect()}
    one = dr.ks_drift(df, ["x"]).first()
    assert [got["x"][c] for c in ("statistic", "p_value", "drifted")] == [one[c] for c in ("statistic", "p_value", "drifted")]
    assert got["x"]["psi"] == pytest.approx(dr.psi(df, ["x"]).first()["psi"])
    assert got["x"]["wasserstein"] == pytest.approx(dr.wasserstein(df, ["x"]).first()["wasserstein"])
    assert got["y"]["p_value"] is None and got["y"]["drifted"] is False
    known = dr.reference_counts(df.where("side = 'reference'"), ["x", "y"], "v1")
    again = {r["feature"]: r for r in dr.drift_from_profile(known, df.where("side = 'current'"), ["x", "y"]).collect()}
    assert again["x"] == got["x"] and again["y"]["drifted"] is False


def test_categories_have_a_p_value(spark):
    rows = [("reference", c) for c in "a" * 60 + "b" * 40] + [("current", c) for c in "a" * 40 + "b" * 60]
    got = dr.category_drift(spark.createDataFrame(rows, "side string, c string"), "c").first()
    assert got["chi_square"] == pytest.approx(8.0) and got["p_value"] == pytest.approx(math.erfc(2.0)) and got["drifted"]
    alone = dr.category_drift(spark.createDataFrame([("reference", "a"), ("current", "a")], "side string, c string"), "c")
    assert alone.first()["p_value"] is None and alone.first()["drifted"] is False
    empty = dr.category_drift(spark.createDataFrame([], "side string, c string"), "c").first()
    assert empty["p_value"] is None and empty["drifted"] is False


def test_moments_of_large_values_do_not_cancel(spark):
    values = [1e9, 1e9 + 1, 1e9 + 2, 1e9 + 2]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = dr.reference_profile(df, ["x"], "v1").first()
    assert got["n"] == 4 and got["std"] == pytest.approx(np.std(values, ddof=1))
    assert dr.reference_profile(df.limit(1), ["x"], "v1").first()["std"] is None
