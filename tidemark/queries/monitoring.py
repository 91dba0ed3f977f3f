"""Monitoring of the event log read as an inference log, in batch and as streams."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.times import truncated
from tidemark.operators import monitoring as mo
from tidemark.operators.quality import downsample
from tidemark.plans.scratch import written_to
from tidemark.queries.base import INFERENCE_SQL, LOG, events, inference_log, rounded
from tidemark.streaming import jobs

WINDOW, STEP = timedelta(hours=6), timedelta(hours=1)
L = f"WITH l AS ({INFERENCE_SQL})"
# each row belongs to the six windows that start up to five hours before its hour
TICKS = """
  , t AS (SELECT l.*, date_trunc('hour', ts) + (6 - i) * INTERVAL 1 HOUR AS tick
          FROM l, (SELECT unnest(range(6)) AS i))
"""


@query("request_counts", f"{L} SELECT model, status, count(*) AS n FROM l GROUP BY ALL")
def request_counts(spark, sf):
    return mo.request_counts(inference_log(spark, sf))


@query("error_counts", f"{L} SELECT model, error_type, count(*) AS n FROM l WHERE status = 'error' GROUP BY ALL")
def error_counts(spark, sf):
    return mo.error_counts(inference_log(spark, sf))


def _histogram_sql(column, bounds):
    lines = [f"SELECT model, '{b:g}' AS le, count(*) FILTER (WHERE {column} <= {b}::DOUBLE) AS n FROM l GROUP BY model"
             for b in bounds]
    return L + " UNION ALL ".join(lines) + " UNION ALL SELECT model, '+Inf', count(*) FROM l GROUP BY model"


@query("latency_histogram", _histogram_sql("latency_s", mo.LATENCY_BOUNDS))
def latency_histogram(spark, sf):
    return mo.latency_histogram(inference_log(spark, sf))


@query("prediction_histogram", _histogram_sql("prediction", mo.PREDICTION_BOUNDS))
def prediction_histogram(spark, sf):
    return mo.prediction_histogram(inference_log(spark, sf))


def _silence_sql(step, table="t"):
    """Counts per model and tick, with a zero for each step from the model's first tick to the last of all."""
    return f"""
      c AS (SELECT model, tick, count(*) AS n FROM {table} GROUP BY model, tick),
      g AS (SELECT model, unnest(generate_series(min(tick), (SELECT max(tick) FROM c), INTERVAL {step})) AS tick
            FROM c GROUP BY model),
      q AS (SELECT g.model, g.tick, coalesce(c.n, 0) AS n
            FROM g LEFT JOIN c ON g.model = c.model AND g.tick = c.tick)
    """


@query("qps_sliding", f"{L} {TICKS}, {_silence_sql('1 HOUR')} SELECT model, tick, n, round(n / 21600, 9) AS qps FROM q")
def qps_sliding(spark, sf):
    return rounded(mo.qps(inference_log(spark, sf), WINDOW, STEP), 9)


@query(
    "qps_default",
    f"""
    {L}, t AS (SELECT model, time_bucket(INTERVAL 30 SECOND, ts) + (10 - i) * INTERVAL 30 SECOND AS tick
               FROM l, (SELECT unnest(range(10)) AS i)),
    {_silence_sql('30 SECOND')} SELECT model, tick, n, round(n / 300, 9) AS qps FROM q
    """,
)
def qps_default(spark, sf):
    """The recording rule as it runs: 5 minutes, evaluated every 30 seconds."""
    return rounded(mo.qps(inference_log(spark, sf)), 9)


@query(
    "error_ratio",
    f"""
    {L} {TICKS} SELECT tick, count(*) AS n, count(*) FILTER (WHERE status = 'error') AS errors,
      round((count(*) FILTER (WHERE status = 'error') / 21600) / greatest(count(*) / 21600, 0.001), 9) AS error_ratio
    FROM t GROUP BY tick
    """,
)
def error_ratio(spark, sf):
    return rounded(mo.error_ratio(inference_log(spark, sf), WINDOW, STEP, floor=0.001), 9)


def _quantile_sql(q):
    """First bucket that reaches the rank, then interpolate."""
    bounds = mo.LATENCY_BOUNDS
    cases = []
    for i, b in enumerate(bounds):
        low, before = (bounds[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        cases.append(
            f"WHEN le_{i} >= {q} * n THEN {low}::DOUBLE + ({b}::DOUBLE - {low}::DOUBLE) * "
            f"(({q}::DOUBLE * n - {before}) / (le_{i} - {before}))"
        )
    return f"round(CASE {' '.join(cases)} ELSE {bounds[-1]}::DOUBLE END, 6)"


@query(
    "histogram_quantile",
    f"{L} {TICKS}, b AS (SELECT model, tick, count(*) AS n, "
    + ", ".join(f"count(*) FILTER (WHERE latency_s <= {b}::DOUBLE) AS le_{i}" for i, b in enumerate(mo.LATENCY_BOUNDS))
    + " FROM t GROUP BY ALL) SELECT model, tick, n, "
    + ", ".join(f"{_quantile_sql(q)} AS p{q * 100:g}" for q in (0.5, 0.95, 0.99))
    + " FROM b",
)
def histogram_quantile(spark, sf):
    return rounded(mo.latency_quantiles(inference_log(spark, sf), window=WINDOW, step=STEP))


SHIFT = f"""
  {L} {TICKS}, s AS (SELECT model, tick, count(*) AS n, sum(prediction) AS total FROM t GROUP BY ALL),
  m AS (SELECT *, (total / 21600) / greatest(n / 21600, 0.001) AS mean FROM s)
"""


@query(
    "prediction_shift",
    SHIFT
    + """
    SELECT model, tick, n, round(total, 6) AS total, round(mean, 12) AS mean_prediction,
           round(abs(mean - 0.1), 12) AS shift, abs(mean - 0.1) > 0.01 AS shifted FROM m
    """,
)
def prediction_shift(spark, sf):
    log = inference_log(spark, sf)
    return rounded(mo.prediction_shift(log, 0.1, 0.01, WINDOW, STEP, floor=0.001), 12, total=6)


def _states_sql(ticks, hours):
    """Alert states of a table of (model, tick, cond)."""
    return f"""
      (WITH m AS ({ticks}),
       g AS (SELECT *, lag(cond, 1, false) OVER w AS was, tick - lag(tick) OVER w AS gap FROM m
             WINDOW w AS (PARTITION BY model ORDER BY tick)),
       f AS (SELECT *, CASE WHEN cond AND (NOT was OR gap IS NULL OR gap <> INTERVAL 1 HOUR) THEN tick END AS first
             FROM g),
       z AS (SELECT model, tick, cond,
                    CASE WHEN cond THEN max(first) OVER (PARTITION BY model ORDER BY tick) END AS since FROM f)
       SELECT model, tick, since, CASE WHEN NOT cond THEN 'inactive'
              WHEN tick - since >= INTERVAL {hours} HOUR THEN 'firing' ELSE 'pending' END AS state FROM z)
    """


def _alerts_sql(rule, states):
    return f"""
      SELECT {rule} model, since, min(tick) FILTER (WHERE state = 'firing') AS fired_at, max(tick) AS last_tick
      FROM {states} WHERE state <> 'inactive' GROUP BY model, since
      HAVING count(*) FILTER (WHERE state = 'firing') > 0
    """


SHIFTED = "SELECT model, tick, abs(sum(prediction) / count(*) - 0.1) > 0.01 AS cond FROM t GROUP BY model, tick"
STATES = f"{L} {TICKS} SELECT * FROM {_states_sql(SHIFTED, 3)}"


def _shift_ticks(spark, sf):
    log = inference_log(spark, sf)
    return mo.prediction_shift(log, 0.1, 0.01, WINDOW, STEP, floor=0.0)


@query("alert_states", STATES)
def alert_states(spark, sf):
    return mo.alert_states(_shift_ticks(spark, sf), ["model"], F.col("shifted"), timedelta(hours=3), STEP)


@query("alert_for", f"{L} {TICKS} " + _alerts_sql("", _states_sql(SHIFTED, 3)))
def alert_for(spark, sf):
    states = mo.alert_states(_shift_ticks(spark, sf), ["model"], F.col("shifted"), timedelta(hours=3), STEP)
    return mo.alerts(states, ["model"])


RULES = (
    mo.AlertRule("errors", "error_ratio", True, 0.22, timedelta(hours=3)),
    mo.AlertRule("slow", "p95", True, 2.0, timedelta(hours=4)),
    mo.AlertRule("traffic", "qps", False, 0.001, timedelta(hours=2)),
    mo.AlertRule("shift", "shift", True, 0.02, timedelta(hours=5)),
)
RULE_WINDOWS = {"window": WINDOW, "step": STEP, "shift_window": WINDOW, "floor": 0.0001, "baseline": 0.1}
RULE_TICKS = {
    "errors": (
        "SELECT '*' AS model, tick, (count(*) FILTER (WHERE status = 'error') / 21600) "
        "/ greatest(count(*) / 21600, 0.0001) > 0.22 AS cond FROM t GROUP BY tick", 3,
    ),
    "slow": (
        f"SELECT model, tick, {_quantile_sql(0.95)} > 2.0 AS cond FROM (SELECT model, tick, count(*) AS n, "
        + ", ".join(f"count(*) FILTER (WHERE latency_s <= {b}::DOUBLE) AS le_{i}" for i, b in enumerate(mo.LATENCY_BOUNDS))
        + " FROM t GROUP BY model, tick)", 4,
    ),
    "traffic": (f"WITH {_silence_sql('1 HOUR')} SELECT model, tick, n / 21600 < 0.001 AS cond FROM q", 2),
    "shift": (
        "SELECT model, tick, abs((sum(prediction) / 21600) / greatest(count(*) / 21600, 0.0001) - 0.1) > 0.02 AS cond "
        "FROM t GROUP BY model, tick", 5,
    ),
}


REPORT = f"{L} {TICKS} " + " UNION ALL ".join(
    _alerts_sql(f"'{name}' AS rule,", _states_sql(ticks, hours)) for name, (ticks, hours) in RULE_TICKS.items()
)


@query("alert_report", REPORT)
def alert_report(spark, sf):
    """Error ratio, latency, traffic and prediction rules over one log."""
    return mo.alert_report(inference_log(spark, sf), RULES, **RULE_WINDOWS)


OUTAGE = f"""
  WITH l AS (SELECT ts, 'u' || user_id AS model FROM events) {TICKS}, {_silence_sql('1 HOUR')},
       a AS (SELECT model, tick, n / 21600 < 0.00001 AS cond FROM q)
"""


def _users_as_models(df):
    return df.select("ts", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("model"))


@query("traffic_outage", OUTAGE + _alerts_sql("", _states_sql("SELECT * FROM a", 12)))
def traffic_outage(spark, sf):
    """Users who were silent for more than twelve hours after their first event, as models without requests."""
    ticks = mo.qps(_users_as_models(events(spark, sf)), WINDOW, STEP)
    states = mo.alert_states(ticks, ["model"], F.col("qps") < 0.00001, timedelta(hours=12), STEP)
    return mo.alerts(states, ["model"])


@query(
    "health_rollup",
    """
    WITH c AS (SELECT date_trunc('hour', ts) AS tick, user_id % 3 AS model, max(value) > 40 AS loaded
               FROM events GROUP BY ALL)
    SELECT tick, count(*) AS n_models, CASE WHEN bool_and(loaded) THEN 'ok' ELSE 'degraded' END AS status
    FROM c GROUP BY tick
    """,
)
def health_rollup(spark, sf):
    df = events(spark, sf)
    model = (F.col("user_id") % 3).alias("model")
    checks = df.groupBy(truncated(df, "ts", "hour").alias("tick"), model).agg((F.max("value") > 40).alias("loaded"))
    return mo.health_rollup(checks)


def _event_stream(spark, sf):
    return jobs.file_stream(spark, sf, events(spark, sf).schema, "events.parquet")


def _ending(spark, sf, stream, window=WINDOW, step=STEP):
    """The end of the log: the last window's end, from the last row's time."""
    last = events(spark, sf).agg(F.max("ts")).first()[0]
    return jobs.Ending(stream, last - (last - datetime.min) % step + window)


@query(
    "stream_downsample",
    """
    SELECT user_id, date_trunc('hour', ts) AS bucket, count(*) AS n, round(avg(value), 6) AS mean_value,
           min(value) AS min_value, max(value) AS max_value, arg_max(value, ts) AS last_value
    FROM events GROUP BY ALL
    """,
)
def stream_downsample(spark, sf):
    """The hourly table as a stream job, up to the last hour once the log has ended."""
    stream = _event_stream(spark, sf)
    ending = _ending(spark, sf, stream, STEP)
    hourly = downsample(ending.watermarked(stream), "value", "1 hour", LOG)
    return rounded(jobs.run_to_table(hourly, "hourly", ending))


@query("stream_qps", f"{L} {TICKS}, {_silence_sql('1 HOUR')} SELECT model, tick, n, round(n / 21600, 9) AS qps FROM q")
def stream_qps(spark, sf):
    """Request rates as a stream job: step sums, then windows over them, up to the last window."""
    stream = _event_stream(spark, sf)
    ending = _ending(spark, sf, stream)
    rates = mo.qps(inference_log(spark, sf, ending.watermarked(stream)), WINDOW, STEP)
    return rounded(mo.zero_rates(jobs.run_to_table(rates, "qps", ending), STEP), 9)


@query(
    "stream_prediction_shift",
    SHIFT
    + """
    SELECT model, tick, n, round(total, 6) AS total, round(mean, 12) AS mean_prediction,
           round(abs(mean - 0.1), 12) AS shift, abs(mean - 0.1) > 0.01 AS shifted FROM m
    """,
)
def stream_prediction_shift(spark, sf):
    stream = _event_stream(spark, sf)
    ending = _ending(spark, sf, stream)
    log = inference_log(spark, sf, ending.watermarked(stream))
    shifts = mo.prediction_shift(log, 0.1, 0.01, WINDOW, STEP, floor=0.001)
    return rounded(jobs.run_to_table(shifts, "shifts", ending), 12, total=6)


@query("stream_outage", OUTAGE + _alerts_sql("", _states_sql("SELECT * FROM a", 12)))
def stream_outage(spark, sf):
    """The traffic alerts again, while the log runs: a timer follows every user, so silence fires without any row."""
    stream = _event_stream(spark, sf)
    ending = _ending(spark, sf, stream)
    ticks = mo.qps(_users_as_models(ending.watermarked(stream)), WINDOW, STEP)
    states = jobs.alert_stream(
        ticks, ["model"], F.col("qps") < 0.00001, timedelta(hours=12), STEP, silent=F.lit(True), watermark=None)
    return mo.alerts(jobs.run_to_table(states, "outages", ending), ["model"])


@query("stream_alert_report", REPORT)
def stream_alert_report(spark, sf):
    """All rules over the log as a stream: step sums, windows, one state per rule and model."""
    stream = _event_stream(spark, sf)
    ending = _ending(spark, sf, stream)
    ticks = mo.rule_ticks(inference_log(spark, sf, ending.watermarked(stream)), RULES, **RULE_WINDOWS)
    states = jobs.alert_stream(
        ticks, ["rule", "model"], F.col("on"), F.col("hold"), STEP, silent=F.col("silent"), watermark=None)
    return mo.alerts(jobs.run_to_table(states, "report", ending), ["rule", "model"])


@query("stream_dedup", "SELECT event_id, user_id, ts, value FROM events")
def stream_dedup(spark, sf):
    """Every event is sent twice; one of the copies comes out."""
    twice = _event_stream(spark, sf).select(
        "event_id", "user_id", "ts", "value", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    )
    return jobs.run_to_table(jobs.drop_copies(twice, ["event_id"]).drop("copy"), "dedup")


@query("stream_alerts", STATES)
def stream_alerts(spark, sf):
    """The alert states again, from a stream over the written evaluation ticks."""
    ticks = _shift_ticks(spark, sf)
    folder, made = written_to(ticks.select("model", "tick", "shifted"), "ticks")
    stream = jobs.file_stream(spark, folder, made.schema)
    states = jobs.alert_stream(stream, ["model"], F.col("shifted"), timedelta(hours=3), STEP)
    return jobs.run_to_table(states, "alerts")
