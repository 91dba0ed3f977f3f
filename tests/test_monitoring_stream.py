from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import monitoring as mo
from tidemark.operators.quality import downsample
from tidemark.queries.base import LOG, events, inference_log
from tidemark.streaming import jobs

T0 = datetime(2024, 1, 1)
STEP = timedelta(minutes=1)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def ticks(spark, pattern, key="m"):
    """One tick per minute; 1 holds, 0 does not, - is missing."""
    made = [(key, T0 + i * STEP, c == "1") for i, c in enumerate(pattern) if c != "-"]
    return spark.createDataFrame(made, "model string, tick timestamp_ntz, on boolean")


@pytest.mark.parametrize(
    "pattern, want",
    [("01111", "ipppf"), ("111-1111", "pppppp" + "f"), ("1101111", "ppippp" + "f"), ("0000", "iiii")],
)
def test_alert_needs_the_condition_to_hold(spark, pattern, want):
    states = mo.alert_states(ticks(spark, pattern), ["model"], F.col("on"), 3 * STEP, STEP)
    assert "".join(r["state"][0] for r in states.orderBy("tick").collect()) == want


def test_raised_alerts(spark):
    states = mo.alert_states(ticks(spark, "0111110"), ["model"], F.col("on"), 3 * STEP, STEP)
    got = mo.alerts(states, ["model"]).first()
    assert (got["since"], got["fired_at"], got["last_tick"]) == (T0 + STEP, T0 + 4 * STEP, T0 + 5 * STEP)


def test_rules(spark):
    names = {r.name: r for r in mo.ALERT_RULES}
    df = spark.createDataFrame([(0.05,), (0.06,), (None,)], "error_ratio double")
    got = df.select(names["HighInferenceErrorRate"].condition().alias("c")).collect()
    assert [r["c"] for r in got] == [False, True, False]


def test_bucket_quantile(spark):
    df = spark.createDataFrame([(T0, "m", 0.07, "ok")] * 50 + [(T0, "m", 99.0, "ok")] * 50, "ts timestamp_ntz, model string, latency_s double, status string")
    got = mo.latency_quantiles(df, (0.25, 0.99), timedelta(minutes=5), timedelta(minutes=5)).first()
    assert got["p25"] == pytest.approx(0.075) and got["p99"] == 5.0


def test_floor_of_the_error_ratio(spark):
    df = spark.createDataFrame([(T0, "m", "error")], "ts timestamp_ntz, model string, status string")
    got = mo.error_ratio(df, timedelta(minutes=5), timedelta(minutes=5)).first()
    assert got["error_ratio"] == pytest.approx(1 / 300)


def test_health(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False), (3, None)], "tick int, loaded boolean")
    assert {r["tick"]: r["status"] for r in mo.health_rollup(df).collect()} == {1: "ok", 2: "degraded", 3: "degraded"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The event log as several files in time order, and one far later row that closes all windows."""
    from conftest import SMALL

    path = str(tmp_path_factory.mktemp("log"))
    log = events(spark, SMALL)
    for i, day in enumerate(("2024-01-10", "2024-01-20", "2024-03-01")):
        low = "2023-01-01" if i == 0 else ("2024-01-10", "2024-01-20")[i - 1]
        part = log.where((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(day).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(path)
    closing = log.limit(1).withColumns({"ts": F.lit("2024-06-01").cast("timestamp_ntz"), "user_id": F.lit(-1).cast("long")})
    closing.coalesce(1).write.mode("append").parquet(path)
    return path


W = timedelta(hours=2), timedelta(hours=1)
MONITORS = {
    "qps": lambda log, wm: mo.qps(log, *W, wm),
    "error_ratio": lambda log, wm: mo.error_ratio(log, *W, watermark=wm),
    "quantiles": lambda log, wm: mo.latency_quantiles(log, window=W[0], step=W[1], watermark=wm),
    "shift": lambda log, wm: mo.prediction_shift(log, window=W[0], step=W[1], watermark=wm),
}


@pytest.mark.parametrize("name", list(MONITORS))
def test_stream_equals_batch(spark, folder, small, name):
    schema = events(spark, small).schema
    stream = inference_log(spark, small, jobs.file_stream(spark, folder, schema, files_per_trigger=1))
    got = jobs.run_to_table(MONITORS[name](stream, jobs.WATERMARK), name)
    got = got.where(F.col("tick") < F.lit("2024-05-01").cast("timestamp_ntz"))
    if name == "qps":
        got = mo.zero_rates(got, W[1])
    want = MONITORS[name](inference_log(spark, small), None)
    places = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
    assert rows(got.select(places)) == rows(want.select(places))


def test_downsample_stream_equals_batch(spark, folder, small):
    stream = jobs.file_stream(spark, folder, events(spark, small).schema, files_per_trigger=1)
    got = jobs.run_to_table(downsample(stream, "value", "1 hour", LOG, jobs.WATERMARK), "hourly")
    assert rows(got.where("user_id >= 0")) == rows(downsample(events(spark, small), "value", "1 hour", LOG))


def test_alert_stream_keeps_state_across_files(spark, tmp_path):
    patterns = {"a": "0111110111101", "b": "11-1111111111"}
    whole = ticks(spark, patterns["a"], "a").unionByName(ticks(spark, patterns["b"], "b"))
    for i in range(3):
        low, high = (F.lit(T0 + (5 * j) * STEP).cast("timestamp_ntz") for j in (i, i + 1))
        whole.where((F.col("tick") >= low) & (F.col("tick") < high)).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    stream = jobs.file_stream(spark, str(tmp_path / "t"), whole.schema, files_per_trigger=1)
    got = jobs.run_to_table(jobs.alert_stream(stream, ["model"], F.col("on"), 3 * STEP, STEP), "alerts")
    assert rows(got) == rows(mo.alert_states(whole, ["model"], F.col("on"), 3 * STEP, STEP))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    # a batch drops rows by the watermark of the batch before it, so the late row comes two batches after
    for t in (T0, T0 + timedelta(days=1), T0 + timedelta(days=1, hours=2), T0):
        spark.createDataFrame([("a", t, 1.0)], "k string, ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    stream = jobs.file_stream(spark, str(tmp_path / "t"), spark.read.parquet(str(tmp_path / "t")).schema, files_per_trigger=1)
    hourly = downsample(stream, "v", "1 hour", Contract(("k",), "ts"), "10 minutes")
    query = (
        hourly.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert jobs.rows_too_late(query) == 1


def test_drift_of_every_batch(spark, folder, small, tmp_path):
    stream = jobs.file_stream(spark, folder, events(spark, small).schema, files_per_trigger=1)
    compare = jobs.drift_each_batch(events(spark, small), ["value"], str(tmp_path / "d"))
    query = stream.writeStream.foreachBatch(compare).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "d"))
    assert got.count() == 4 and got.where("n_columns = 1").count() == 4
