"""Point-in-time joins and the latest-value table over the event log."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog import query
from tidemark.contract import Contract, FeatureService, FeatureView
from tidemark.operators import store as st
from tidemark.operators.online import OnlineTable
from tidemark.plans.scratch import fresh_path
from tidemark.queries.base import LOG, events, rounded
from tidemark.session import table

SPINE = ["event_id", "user_id", "ts"]
START, END = datetime(2024, 1, 5), datetime(2024, 1, 25)


def _kind(spark, sf, kind):
    return events(spark, sf).where(F.col("event_type") == kind)


def _spine(spark, sf):
    return _kind(spark, sf, "purchase").select(*SPINE)


def _clicks(spark, sf, ttl=None, prefix=""):
    clicks = _kind(spark, sf, "click").select("user_id", "ts", F.col("value").alias("click_value"))
    return st.Source(clicks, LOG, ("click_value",), ttl, prefix)


SQL_SIDES = """
  WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
       c AS (SELECT user_id, ts AS feature_ts, value AS click_value FROM events WHERE event_type = 'click'),
       v AS (SELECT user_id, ts AS feature_ts, value AS view_value FROM events WHERE event_type = 'view'),
       e AS (SELECT user_id, ts AS feature_ts, value AS error_value FROM events WHERE event_type = 'error')
"""


@query(
    "asof_join",
    SQL_SIDES
    + """
    SELECT s.event_id, s.user_id, s.ts, c.feature_ts, c.click_value
    FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.feature_ts
    """,
)
def asof_join(spark, sf):
    return st.asof_join(_spine(spark, sf), [_clicks(spark, sf)], LOG, keep_feature_time=True)


@query(
    "historical_features",
    SQL_SIDES
    + """
    SELECT s.event_id, s.user_id, s.ts,
           CASE WHEN c.feature_ts >= s.ts - INTERVAL 6 HOUR THEN c.click_value END AS click_value, v.view_value
    FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.feature_ts
           ASOF LEFT JOIN v ON s.user_id = v.user_id AND s.ts >= v.feature_ts
    """,
)
def historical_features(spark, sf):
    """Training rows for a service of two views, one of them with a time to live."""
    kinds = {"click": timedelta(hours=6), "view": None}
    number = {k: T.StructType([T.StructField(f"{k}_value", T.DoubleType())]) for k in kinds}
    views = [FeatureView(k, number[k], LOG, ttl) for k, ttl in kinds.items()]
    tables = {
        k: _kind(spark, sf, k).select("user_id", "ts", F.col("value").alias(f"{k}_value")) for k in kinds
    }
    service = FeatureService("clicks_and_views", tuple(views))
    return st.historical_features(_spine(spark, sf), tables, views, service=service, contract=LOG)


@query(
    "asof_join_ttl",
    SQL_SIDES
    + """
    SELECT s.event_id, s.user_id, s.ts,
           CASE WHEN c.feature_ts >= s.ts - INTERVAL 6 HOUR THEN c.feature_ts END AS feature_ts,
           CASE WHEN c.feature_ts >= s.ts - INTERVAL 6 HOUR THEN c.click_value END AS click_value
    FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.feature_ts
    """,
)
def asof_join_ttl(spark, sf):
    clicks = _clicks(spark, sf, timedelta(hours=6))
    return st.asof_join(_spine(spark, sf), [clicks], LOG, keep_feature_time=True)


@query(
    "asof_multi_view",
    SQL_SIDES
    + """
    SELECT s.event_id, s.user_id, s.ts,
           CASE WHEN c.feature_ts >= s.ts - INTERVAL 2 DAY THEN c.click_value END AS click_value,
           v.view_value,
           CASE WHEN e.feature_ts >= s.ts - INTERVAL 12 HOUR THEN e.error_value END AS error_value
    FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.feature_ts
    ASOF LEFT JOIN v ON s.user_id = v.user_id AND s.ts >= v.feature_ts
    ASOF LEFT JOIN e ON s.user_id = e.user_id AND s.ts >= e.feature_ts
    """,
)
def asof_multi_view(spark, sf):
    """Two feature views and the label view on one spine, in one shuffle."""
    def source(kind, ttl):
        column = f"{kind}_value"
        rows = _kind(spark, sf, kind).select("user_id", "ts", F.col("value").alias(column))
        return st.Source(rows, LOG, (column,), ttl)

    views = [source("click", timedelta(days=2)), source("view", None), source("error", timedelta(hours=12))]
    return st.asof_join(_spine(spark, sf), views, LOG)


@query(
    "asof_composite",
    """
    WITH s AS (SELECT event_id, user_id, event_type, ts FROM events WHERE value > 60),
         f AS (SELECT user_id, event_type, ts AS fts, value FROM events WHERE value <= 60)
    SELECT s.*, f.value AS low_value
    FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.event_type = f.event_type AND s.ts >= f.fts
    """,
)
def asof_composite(spark, sf):
    both = Contract(("user_id", "event_type"), "ts")
    df = events(spark, sf)
    low = df.where("value <= 60").select("user_id", "event_type", "ts", F.col("value").alias("low_value"))
    spine = df.where("value > 60").select("event_id", "user_id", "event_type", "ts")
    return st.asof_join(spine, [st.Source(low, both, ("low_value",))], both)


LATEST_SQL = """
  SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY user_id
"""


def _latest(spark, sf):
    return st.latest_rows(events(spark, sf), ["value"], LOG, START, END)


@query("materialize_latest", LATEST_SQL)
def materialize_latest(spark, sf):
    return _latest(spark, sf)


@query("materialize_steps", LATEST_SQL)
def materialize_steps(spark, sf):
    """The same table in three steps of the log: each reads the rows after the mark and rewrites the parts they touch."""
    df = events(spark, sf)
    online = OnlineTable(spark, fresh_path(spark, "online"), df.schema, ["value"], LOG)
    for end in (START + timedelta(days=8), START + timedelta(days=15), END):
        online.step(df, end, START)
    return online.rows()


@query(
    "latest_lookup",
    f"""
    WITH latest AS ({LATEST_SQL}), k AS (SELECT c_custkey AS user_id FROM customer)
    SELECT k.user_id, latest.value FROM k LEFT JOIN latest ON k.user_id = latest.user_id
    """,
)
def latest_lookup(spark, sf):
    """Keys come from the customer table, most of which have no events."""
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return st.latest_lookup(keys, _latest(spark, sf), LOG)


@query(
    "stale_entities",
    f"""
    WITH latest AS ({LATEST_SQL})
    SELECT user_id, ts, round(epoch_us(TIMESTAMP '2024-01-25') / 1e6 - epoch_us(ts) / 1e6, 3) AS age_s,
           ts < TIMESTAMP '2024-01-25' - INTERVAL 12 HOUR AS stale
    FROM latest
    """,
)
def stale_entities(spark, sf):
    as_of = F.lit(END).cast("timestamp_ntz")
    return rounded(st.freshness(_latest(spark, sf), as_of, timedelta(hours=12), LOG), 3)


@query(
    "skew_check",
    """
    WITH offline AS (SELECT user_id, arg_max(value, ts) AS value, max(ts) AS ts FROM events GROUP BY user_id),
         online AS (SELECT user_id, arg_max(value, ts) AS value, max(ts) AS ts FROM events
                    WHERE ts <= TIMESTAMP '2024-01-30' AND event_type <> 'view' GROUP BY user_id)
    SELECT coalesce(o.user_id, n.user_id) AS user_id, o.user_id IS NOT NULL AS in_offline,
           n.user_id IS NOT NULL AS in_online,
           CAST(o.value IS DISTINCT FROM n.value AS INTEGER) + CAST(o.ts IS DISTINCT FROM n.ts AS INTEGER)
             AS n_different
    FROM offline o FULL OUTER JOIN online n ON o.user_id = n.user_id
    """,
)
def skew_check(spark, sf):
    """As-of(now) values against an online table that is behind and lacks one kind of event."""
    df = events(spark, sf)
    now = df.select("user_id").distinct().withColumn("now", F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz"))
    source = st.Source(df, LOG, ("value",))
    offline = st.asof_join(now, [source], Contract(("user_id",), "now"), keep_feature_time=True)
    online = st.latest_rows(df.where("event_type <> 'view'"), ["value"], LOG, end=datetime(2024, 1, 30))
    return st.skew_check(offline.withColumnRenamed("feature_ts", "ts"), online, ["value", "ts"], ["user_id"])


@query(
    "naive_join_leak_count",
    SQL_SIDES
    + """
    , l AS (SELECT user_id, max(feature_ts) AS feature_ts FROM c GROUP BY user_id)
    SELECT count(*) AS n_rows, count(l.feature_ts) AS n_matched,
           count(*) FILTER (WHERE l.feature_ts > s.ts) AS n_leaking
    FROM s LEFT JOIN l ON s.user_id = l.user_id
    """,
)
def naive_join_leak_count(spark, sf):
    latest = st.latest_rows(_kind(spark, sf, "click"), ["value"], LOG)
    return st.leak_audit(st.naive_join(_spine(spark, sf), latest, ["value"], LOG), time="ts")


@query(
    "entity_coverage",
    """
    WITH s AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'),
         f AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'click')
    SELECT coalesce(s.user_id, f.user_id) AS user_id,
           CASE WHEN f.user_id IS NULL THEN 'spine_only' WHEN s.user_id IS NULL THEN 'features_only'
                ELSE 'both' END AS coverage
    FROM s FULL OUTER JOIN f ON s.user_id = f.user_id
    """,
)
def entity_coverage(spark, sf):
    return st.entity_coverage(_kind(spark, sf, "purchase"), _kind(spark, sf, "click"), ["user_id"])


@query(
    "asof_coverage",
    SQL_SIDES
    + """
    , j AS (SELECT s.ts, CASE WHEN c.feature_ts >= s.ts - INTERVAL 6 HOUR THEN c.feature_ts END AS cts,
                   CASE WHEN v.feature_ts >= s.ts - INTERVAL 5 DAY THEN v.feature_ts END AS vts
            FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.feature_ts
            ASOF LEFT JOIN v ON s.user_id = v.user_id AND s.ts >= v.feature_ts),
      a AS (SELECT 'click' AS view, cts AS f, ts FROM j UNION ALL SELECT 'view', vts, ts FROM j)
    SELECT view, count(*) AS n_spine, count(*) - count(f) AS n_missing,
           round((count(*) - count(f)) / count(*), 6) AS share_missing,
           round(min((epoch_us(ts) - epoch_us(f)) / 1e6), 3) AS min_age_s,
           round(avg((epoch_us(ts) - epoch_us(f)) / 1e6), 3) AS mean_age_s,
           round(max((epoch_us(ts) - epoch_us(f)) / 1e6), 3) AS max_age_s
    FROM a GROUP BY view
    """,
)
def asof_coverage(spark, sf):
    def source(kind, ttl):
        return st.Source(_kind(spark, sf, kind), LOG, ("value",), ttl, f"{kind}__")

    views = [source("click", timedelta(hours=6)), source("view", timedelta(days=5))]
    joined = st.asof_join(_spine(spark, sf), views, LOG, keep_feature_time=True)
    times = {"click": "click__feature_ts", "view": "view__feature_ts"}
    return rounded(st.match_coverage(joined, times, "ts"), 3, share_missing=6)


@query(
    "leak_audit",
    SQL_SIDES
    + """
    SELECT count(*) AS n_rows, count(c.feature_ts) AS n_matched, count(*) FILTER (WHERE c.feature_ts > s.ts) AS n_leaking
    FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.feature_ts
    """,
)
def leak_audit(spark, sf):
    joined = st.asof_join(_spine(spark, sf), [_clicks(spark, sf)], LOG, keep_feature_time=True)
    return st.leak_audit(joined, time="ts")


@query(
    "prediction_trace",
    """
    WITH s AS (SELECT event_id AS prediction_id, user_id, ts FROM events WHERE event_type = 'purchase'),
         f AS (SELECT user_id, ts AS feature_ts, event_id AS feature_row FROM events
               WHERE event_type IN ('click', 'view'))
    SELECT s.prediction_id, s.user_id, s.ts, f.feature_ts, f.feature_row
    FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.feature_ts
    """,
)
def prediction_trace(spark, sf):
    """Which stored row each prediction was made from."""
    rows = events(spark, sf).where(F.col("event_type").isin("click", "view"))
    rows = rows.select("user_id", "ts", F.col("event_id").alias("feature_row"))
    made = _spine(spark, sf).withColumnRenamed("event_id", "prediction_id")
    return st.asof_join(made, [st.Source(rows, LOG, ("feature_row",))], LOG, keep_feature_time=True)


@query(
    "asof_forward",
    SQL_SIDES
    + """
    SELECT s.event_id, s.user_id, s.ts, e.feature_ts, e.error_value
    FROM s ASOF LEFT JOIN e ON s.user_id = e.user_id AND s.ts <= e.feature_ts
    """,
)
def asof_forward(spark, sf):
    """The first label at or after each spine row."""
    errors = _kind(spark, sf, "error").select("user_id", "ts", F.col("value").alias("error_value"))
    source = st.Source(errors, LOG, ("error_value",))
    return st.asof_join(_spine(spark, sf), [source], LOG, keep_feature_time=True, direction="forward")
