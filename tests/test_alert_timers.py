"""Alerts over streams: silence, long backlogs, rows out of order, keys that are forgotten, ends of streams."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from test_monitoring_stream import STEP, T0, rows

from tidemark.operators import monitoring as mo
from tidemark.streaming import jobs

SCHEMA = "model string, tick timestamp_ntz, on boolean"


def parts_of(spark, made, folder, cuts):
    """Rows as files that arrive one after the other, each in any order."""
    rng = random.Random(5)
    for low, high in zip([T0, *cuts], [*cuts, datetime.max]):
        some = [r for r in made if low <= r[1] < high]
        rng.shuffle(some)
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return jobs.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


def quiet_batch(whole, silent):
    """Batch ticks with a row at every silent step, up to the last tick of all."""
    filled = mo.with_silence(whole.withColumn("n", F.lit(1)), ["model"], STEP, ["n", "on"])
    return filled.withColumn("on", F.when(F.col("n") > 0, F.col("on")).otherwise(F.lit(silent))).drop("n")


def ticks(n, seed, gaps=0.0):
    rng = random.Random(seed)
    state, made = False, []
    for i in range(n):
        state = state if rng.random() < 0.9 else not state
        if rng.random() >= gaps:
            made.append((T0 + i * STEP, state))
    return made


def test_silent_model_fires_by_timer(spark, tmp_path):
    made = [("a", t, on) for t, on in ticks(30, 1)] + [("b", t, on) for t, on in ticks(200, 2)]
    stream = parts_of(spark, made, str(tmp_path / "t"), [T0 + 60 * STEP, T0 + 120 * STEP])
    hold = 20 * STEP
    got = jobs.run_to_table(
        jobs.alert_stream(stream, ["model"], F.col("on"), hold, STEP, silent=F.lit(True)), "alerts")
    whole = spark.createDataFrame(made, SCHEMA)
    want = mo.alert_states(quiet_batch(whole, True), ["model"], F.col("on"), hold, STEP)
    assert rows(got) == rows(want)
    raised = mo.alerts(got, ["model"]).where("model = 'a'").collect()
    assert max(r.last_tick for r in raised) == T0 + 199 * STEP  # long after the model's last row


def test_long_backlog_with_gaps_in_any_order(spark, tmp_path):
    made = [(m, t, on) for m in "abc" for t, on in ticks(1700, ord(m), 0.02)]
    stream = parts_of(spark, made, str(tmp_path / "t"), [T0 + 1500 * STEP])
    got = jobs.run_to_table(jobs.alert_stream(stream, ["model"], F.col("on"), 4 * STEP, STEP), "alerts")
    want = mo.alert_states(spark.createDataFrame(made, SCHEMA), ["model"], F.col("on"), 4 * STEP, STEP)
    assert rows(got) == rows(want)


def test_forgotten_keys_have_no_more_rows(spark, tmp_path):
    made = [("a", T0 + i * STEP, True) for i in (0, 1, 150)] + [("b", T0 + i * STEP, False) for i in range(200)]
    stream = parts_of(spark, made, str(tmp_path / "t"), [T0 + 100 * STEP])
    got = jobs.run_to_table(
        jobs.alert_stream(stream, ["model"], F.col("on"), STEP, STEP, silent=F.lit(False), forget=10 * STEP), "alerts")
    of_a = sorted((r.tick - T0) / STEP for r in got.where("model = 'a'").collect())
    assert of_a == [*range(0, 12), *range(150, 161)]
    assert got.where("model = 'b'").count() == 200


def test_end_of_a_stream_gives_the_last_windows_whatever_is_filtered(spark, tmp_path):
    made = [(f"k{i % 3}", T0 + i * STEP, float(i)) for i in range(50)] + [("k0", T0 + 20 * STEP, None)]
    df = spark.createDataFrame(made, "k string, ts timestamp_ntz, v double")
    df.coalesce(1).write.parquet(str(tmp_path / "t"))
    stream = jobs.file_stream(spark, str(tmp_path / "t"), df.schema)
    ending = jobs.Ending(stream, T0 + 60 * STEP)
    shape = lambda log: mo.windowed_sums(
        log.where("v is not null and k <> 'k1'"), {"n": F.lit(1), "v": F.col("v")}, ["k"], 10 * STEP, 5 * STEP)
    got = jobs.run_to_table(shape(ending.watermarked(stream)), "sums", ending)
    assert rows(got) == rows(shape(df))
    without = jobs.run_to_table(shape(stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "10 minutes")), "open")
    assert without.count() < got.count()


def test_rules_of_one_log_agree_in_batch_and_stream(spark, tmp_path):
    rng = random.Random(4)
    made = [(T0 + timedelta(seconds=7 * i), f"m{i % 2}", rng.choice(["ok", "ok", "error"]),
             rng.choice([0.1, 2.0, None]), rng.choice([0.9, 0.2, None])) for i in range(900) if not 300 < i < 500]
    df = spark.createDataFrame(made, "ts timestamp_ntz, model string, status string, latency_s double, prediction double")
    df.coalesce(1).write.parquet(str(tmp_path / "t"))
    second = timedelta(seconds=1)
    rules = tuple(mo.AlertRule(r.name, r.measure, r.above, limit, hold * second) for r, limit, hold in zip(
        mo.ALERT_RULES, (0.3, 0.5, 0.01, 0.05), (60, 90, 120, 60)))
    batch = mo.alert_report(df, rules, floor=0.001, shift_window=mo.RATE_WINDOW)
    stream = jobs.file_stream(spark, str(tmp_path / "t"), df.schema)
    ending = jobs.Ending(stream, mo.rule_ticks(df, rules, floor=0.001, shift_window=mo.RATE_WINDOW).agg(F.max("tick")).first()[0])
    ticks = mo.rule_ticks(ending.watermarked(stream), rules, floor=0.001, shift_window=mo.RATE_WINDOW)
    states = jobs.alert_stream(
        ticks, ["rule", "model"], F.col("on"), F.col("hold"), mo.RATE_STEP, silent=F.col("silent"), watermark=None)
    got = mo.alerts(jobs.run_to_table(states, "report", ending), ["rule", "model"])
    assert rows(got) == rows(batch)
    assert {r.rule for r in batch.collect()} == {r.name for r in rules}
