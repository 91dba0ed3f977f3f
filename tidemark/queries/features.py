"""Window features over the event log."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.operators import features as fx
from tidemark.contract import Contract
from tidemark.queries.base import LOG, events, labelled, rounded

KEYS = ["event_id", "user_id", "ts"]


def _features(df, features, places=6):
    made = fx.build_features(df.select(*KEYS, "value"), features, LOG)
    return rounded(made.select(*KEYS, *[f.name for f in features]), places)


@query(
    "rolling_mean_lagged",
    """
    SELECT event_id, user_id, ts, round(coalesce(avg(value) OVER w, 0.0), 6) AS value_roll_mean
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
    """,
)
def rolling_mean_lagged(spark, sf):
    return _features(events(spark, sf), [fx.Feature("value_roll_mean", "value", "mean", 3)])


@query(
    "rolling_std_lagged",
    """
    SELECT event_id, user_id, ts, round(coalesce(stddev_samp(value) OVER w, 0.0), 4) AS value_roll_std
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
    """,
)
def rolling_std_lagged(spark, sf):
    return _features(events(spark, sf), [fx.Feature("value_roll_std", "value", "std", 6)], 4)


@query(
    "delta",
    """
    SELECT event_id, user_id, ts,
           round(coalesce(value - lag(value) OVER w, 0.0), 6) AS value_delta,
           round(coalesce(lag(value) OVER w - lag(value, 2) OVER w, 0.0), 6) AS value_delta_strict
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    """,
)
def delta(spark, sf):
    return _features(
        events(spark, sf),
        [fx.Feature("value_delta", "value", "delta"), fx.Feature("value_delta_strict", "value", "delta", strict=True)],
    )


@query(
    "rolling_mean_leaky",
    """
    SELECT event_id, user_id, ts, round(avg(value) OVER w, 6) AS value_roll_leaky
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)
def rolling_mean_leaky(spark, sf):
    return _features(events(spark, sf), [fx.Feature("value_roll_leaky", "value", "mean", 3, shifted=False)])


@query(
    "leak_compare",
    """
    SELECT * FROM (
      SELECT event_id, user_id, ts, value AS value__leak, round(avg(value) OVER w, 6) AS value__ok
      FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
    ) WHERE value__ok IS NOT NULL AND value__leak IS NOT NULL
    """,
)
def leak_compare(spark, sf):
    made = fx.leak_compare(events(spark, sf).select(*KEYS, "value"), ["value"], 6, LOG)
    return rounded(made.select(*KEYS, "value__leak", "value__ok"))


@query(
    "lag_features",
    """
    SELECT event_id, user_id, ts, coalesce(lag(value, 1) OVER w, 0.0) AS value_lag_1,
           coalesce(lag(value, 3) OVER w, 0.0) AS value_lag_3, coalesce(lag(value, 6) OVER w, 0.0) AS value_lag_6
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    """,
)
def lag_features(spark, sf):
    return _features(events(spark, sf), [fx.Feature(f"value_lag_{k}", "value", "lag", k) for k in (1, 3, 6)])


@query(
    "feature_row",
    """
    SELECT event_id, user_id, ts,
           round(coalesce(avg(value) OVER w, 0.0), 6) AS temp_roll_mean,
           round(coalesce(stddev_samp(value * 2) OVER w, 0.0), 4) AS vib_roll_std,
           round(coalesce(avg(value + 1) OVER w, 0.0), 6) AS current_roll_mean,
           round(coalesce(value - lag(value) OVER o, 0.0), 6) AS temp_delta
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING),
           o AS (PARTITION BY user_id ORDER BY ts)
    """,
)
def feature_row(spark, sf):
    """De-duplicate, then all four sensor features, in one shuffle."""
    readings = events(spark, sf).select(
        *KEYS, F.col("value").alias("temperature"), (F.col("value") * 2).alias("vibration"),
        (F.col("value") + 1).alias("current"),
    )
    features = fx.sensor_features(6)
    made = fx.clean_and_build(readings, features, Contract(("user_id",), "ts", ("event_id",)))
    return rounded(made.select(*KEYS, *[f.name for f in features]), 6, vib_roll_std=4)


@query(
    "supervised_windows",
    """
    WITH s AS (
      SELECT user_id, ts, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n, value
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    ), anchors AS (SELECT user_id, ts, i FROM s WHERE i >= 6 AND i + 3 <= n)
    SELECT a.user_id, a.ts, CASE WHEN s.i <= a.i THEN 'input' ELSE 'target' END AS part,
           CAST(CASE WHEN s.i <= a.i THEN s.i - a.i + 5 ELSE s.i - a.i - 1 END AS INTEGER) AS step, s.value
    FROM anchors a JOIN s ON s.user_id = a.user_id AND s.i BETWEEN a.i - 5 AND a.i + 3
    """,
)
def supervised_windows(spark, sf):
    """Samples of 6 past and 3 next readings, shown one element per row."""
    made = fx.supervised_windows(events(spark, sf), "value", 6, 3, LOG)
    both = F.map_from_arrays(F.array(F.lit("input"), F.lit("target")), F.array("inputs", "targets"))
    parts = made.select("user_id", "ts", F.explode(both).alias("part", "elements"))
    return parts.select("user_id", "ts", "part", F.posexplode("elements").alias("step", "value"))


@query(
    "expanding_mean",
    """
    SELECT event_id, user_id, ts, round(avg(value) OVER w, 10) AS mean
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def expanding_mean(spark, sf):
    return rounded(fx.expanding_mean(events(spark, sf).select(*KEYS, "value"), "value", LOG).drop("value"), 10)


@query(
    "head_per_entity",
    """
    SELECT event_id, user_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts) <= 24
    """,
)
def head_per_entity(spark, sf):
    return fx.head_per_entity(events(spark, sf).drop("props"), 24, LOG)


@query(
    "entity_corr",
    """
    SELECT count(*) AS n_entities, round(corr(m, r), 6) AS correlation
    FROM (SELECT user_id, avg(value) AS m, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS r
          FROM events GROUP BY user_id)
    """,
)
def entity_corr(spark, sf):
    return rounded(fx.entity_correlation(labelled(spark, sf), "value", "label", LOG))
