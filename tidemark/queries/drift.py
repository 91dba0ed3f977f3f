"""Drift between the time halves of the event log, and between two periods of lineitem."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.times import truncated
from tidemark.operators import drift as dr
from tidemark.operators import evaluation as ev
from tidemark.operators import rolling as ro
from tidemark.operators import store as st
from tidemark.operators.splits import reference_current
from tidemark.plans.scratch import written
from tidemark.queries.base import LINES, LOG, SCORED_SQL, events, labelled, rounded, scored
from tidemark.queries.evaluation import CONFUSION, RATES
from tidemark.session import table
from tidemark.sources.versions import fingerprint
from tidemark.streaming import jobs
from tidemark.streaming.labels import label_feedback

CUT = "1999-01-01"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _halves(spark, sf, *columns):
    return reference_current(labelled(spark, sf), ["value", *columns], LOG)


def _periods(spark, sf):
    """Lineitem before and after a fixed day: the cut is a constant, so no ranking is needed."""
    side = F.when(F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"), "reference").otherwise("current")
    return table(spark, sf, "lineitem").select(*MEASURES, side.alias("side"))


HALVES = """
  WITH h AS (SELECT *, CAST(event_type = 'error' AS INTEGER) AS label,
                    CASE WHEN row_number() OVER (ORDER BY ts, user_id) <= count(*) OVER () // 2
                         THEN 'reference' ELSE 'current' END AS side FROM events)
"""
PERIODS = f"""
  WITH b AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'reference' ELSE 'current' END AS side
             FROM lineitem),
  long AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, side FROM b" for c in MEASURES) + ")"


def _frame_sql(source, groups):
    """Distinct values with running counts on both sides, for the rows of ``source``."""
    return f"""
      , counts AS (SELECT {groups}, value, count(*) FILTER (WHERE side = 'reference') AS ref,
                          count(*) FILTER (WHERE side = 'current') AS cur FROM {source} GROUP BY {groups}, value),
      frame AS (SELECT *, sum(ref) OVER w AS cum_ref, sum(cur) OVER w AS cum_cur,
                       sum(ref) OVER (PARTITION BY {groups}) AS n_ref, sum(cur) OVER (PARTITION BY {groups}) AS n_cur,
                       lead(value) OVER o AS next FROM counts
                WINDOW w AS (PARTITION BY {groups} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       o AS (PARTITION BY {groups} ORDER BY value))
    """


def _ks_sql(groups):
    gap = "abs(coalesce(cum_ref::DOUBLE / nullif(n_ref, 0), 0) - coalesce(cum_cur::DOUBLE / nullif(n_cur, 0), 0))"
    return f"""
      , ks AS (SELECT {groups}, CAST(any_value(n_ref) AS BIGINT) AS n_ref, CAST(any_value(n_cur) AS BIGINT) AS n_cur,
                      max({gap}) AS d FROM frame GROUP BY {groups}),
      root AS (SELECT *, sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS r FROM ks WHERE n_ref + n_cur > 0),
      lam AS (SELECT *, CASE WHEN r > 0 THEN (r + 0.12 + 0.11 / r) * d END AS x FROM root),
      tested AS (SELECT *, CASE WHEN n_ref = 0 OR n_cur = 0 THEN NULL WHEN x < 0.2 THEN 1.0::DOUBLE ELSE
                 greatest(0, least(1, 2 * list_sum(list_transform(range(1, 101), lambda k:
                   (CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) * exp(-2.0::DOUBLE * k * k * x * x)))))
                 END AS p FROM lam),
      result AS (SELECT {groups}, n_ref, n_cur, round(d, 6) AS statistic, round(p, 6) AS p_value,
                        coalesce(p < 0.05, false) AS drifted FROM tested)
    """


@query("ks_drift", PERIODS + _frame_sql("long", "feature") + _ks_sql("feature") + " SELECT * FROM result")
def ks_drift(spark, sf):
    return rounded(dr.ks_drift(_periods(spark, sf), MEASURES))


@query(
    "ks_drift_halves",
    HALVES
    + ", long AS (SELECT 'value' AS feature, value, side FROM h)"
    + _frame_sql("long", "feature")
    + _ks_sql("feature")
    + " SELECT * FROM result",
)
def ks_drift_halves(spark, sf):
    return rounded(dr.ks_drift(_halves(spark, sf), ["value"]))


ROLLUP = """
  SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
         round(count(*) FILTER (WHERE drifted) / count(*), 6) AS share_drifted,
         count(*) FILTER (WHERE drifted) / count(*) > 0.5 AS dataset_drift FROM result
"""


def _shifted(spark, sf):
    """Quantity shifted and price scaled on the current side only."""
    base = _periods(spark, sf)
    current = base.where("side = 'current'")
    moved = dr.inject_drift(dr.inject_drift(current, "l_quantity", 8.0), "l_extendedprice", scale=1.5)
    return base.where("side = 'reference'").unionByName(moved)


SHIFTED = PERIODS.replace("SELECT *, CASE", "SELECT l_orderkey, l_shipdate, l_discount, l_tax, "
                          f"CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN l_quantity ELSE l_quantity + 8.0 END "
                          f"AS l_quantity, CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN l_extendedprice "
                          "ELSE l_extendedprice * 1.5 END AS l_extendedprice, CASE")


@query("dataset_drift", SHIFTED + _frame_sql("long", "feature") + _ks_sql("feature") + ROLLUP)
def dataset_drift(spark, sf):
    return rounded(dr.dataset_drift(dr.ks_drift(_shifted(spark, sf), MEASURES)))


@query(
    "inject_drift",
    "SELECT event_id, round(value * 1.5 + 8.0, 6) AS value FROM events",
)
def inject_drift(spark, sf):
    return rounded(dr.inject_drift(events(spark, sf).select("event_id", "value"), "value", 8.0, 1.5))


@query(
    "current_window",
    "SELECT event_id, ts, value FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR",
)
def current_window(spark, sf):
    return dr.current_window(events(spark, sf).select("event_id", "ts", "value"), contract=LOG)


PSI = """
  , binned AS (SELECT {g}, least(9, floor((cum_ref - ref) * 10 / n_ref)) AS bin,
                      greatest(sum(ref)::DOUBLE / any_value(n_ref), 1e-4) AS r,
                      greatest(sum(cur)::DOUBLE / any_value(n_cur), 1e-4) AS c FROM frame GROUP BY ALL)
  SELECT {g}, round(sum((c - r) * ln(c / r)), 6) AS psi FROM binned GROUP BY {g}
"""


@query("psi", SHIFTED + _frame_sql("long", "feature") + PSI.format(g="feature"))
def psi(spark, sf):
    return rounded(dr.psi(_shifted(spark, sf), MEASURES))


@query(
    "wasserstein",
    SHIFTED
    + _frame_sql("long", "feature")
    + """
    SELECT feature, round(coalesce(sum(abs(cum_ref::DOUBLE / n_ref - cum_cur::DOUBLE / n_cur) * (next - value)), 0), 6)
           AS wasserstein FROM frame GROUP BY feature
    """,
)
def wasserstein(spark, sf):
    return rounded(dr.wasserstein(_shifted(spark, sf), MEASURES))


@query(
    "drift_sweep",
    HALVES
    + """
    , sd AS (SELECT stddev_samp(value) AS s FROM h WHERE side = 'reference'),
    long AS (SELECT 'value' AS feature, k AS shift_sd, side,
                    CASE WHEN side = 'reference' THEN value ELSE value + k * (SELECT s FROM sd) END AS value
             FROM h, (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]::DOUBLE[]) AS k))
    """
    + _frame_sql("long", "shift_sd, feature")
    + _ks_sql("shift_sd, feature")
    + " SELECT * FROM result",
)
def drift_sweep(spark, sf):
    return rounded(dr.drift_sweep(_halves(spark, sf), "value"))


@query(
    "hist_overlay",
    PERIODS
    + """
    , e AS (SELECT feature, min(value) AS low, max(value) AS high FROM long GROUP BY feature),
    n AS (SELECT l.feature, l.side, low, high,
                 CAST(least(24, floor((value - low) / (high - low) * 25)) AS INTEGER) AS bin, count(*) AS n
          FROM long l JOIN e ON l.feature = e.feature GROUP BY ALL)
    SELECT feature, side, bin, round(low + bin * ((high - low) / 25), 6) AS edge, n,
           round(n / (sum(n) OVER (PARTITION BY feature, side) * ((high - low) / 25)), 9) AS density FROM n
    """,
)
def hist_overlay(spark, sf):
    return rounded(dr.overlay_histogram(_periods(spark, sf), MEASURES), 6, density=9)


@query(
    "entity_mix",
    HALVES
    + """
    SELECT user_id, count(*) FILTER (WHERE side = 'reference') AS n_ref,
           count(*) FILTER (WHERE side = 'current') AS n_cur,
           count(*) FILTER (WHERE side = 'reference') > 0 AND count(*) FILTER (WHERE side = 'current') > 0 AS in_both
    FROM h GROUP BY user_id
    """,
)
def entity_mix(spark, sf):
    return dr.entity_mix(_halves(spark, sf), ["user_id"])


CATEGORIES = """
    , c AS (SELECT event_type, count(*) FILTER (WHERE side = 'reference')::DOUBLE AS a,
                   count(*) FILTER (WHERE side = 'current')::DOUBLE AS b FROM h GROUP BY event_type),
    t AS (SELECT *, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM c),
    x AS (SELECT *, (a + b) * ta / (ta + tb) AS ea, (a + b) * tb / (ta + tb) AS eb,
                 greatest(a / ta, 1e-4) AS sa, greatest(b / tb, 1e-4) AS sb FROM t),
    chi AS (SELECT sum((a - ea) ** 2 / ea + (b - eb) ** 2 / eb) AS chi, count(*) - 1 AS dof,
                   sum((sb - sa) * ln(sb / sa)) AS psi FROM x),
    chi_test AS (SELECT *, CASE WHEN dof = 0 THEN NULL WHEN chi <= 0 THEN 1.0::DOUBLE ELSE
                 greatest(0.0::DOUBLE, 1.0::DOUBLE - list_sum(list_transform(range(0, 2000), lambda n:
                   exp((dof / 2.0::DOUBLE + n) * ln(chi / 2) - chi / 2 - lgamma(dof / 2.0::DOUBLE + n + 1)))))
                 END AS chi_p FROM chi)
"""


@query(
    "category_drift",
    HALVES
    + CATEGORIES
    + """
    SELECT round(chi, 6) AS chi_square, dof, round(psi, 9) AS psi, round(chi_p, 6) AS p_value,
           coalesce(chi_p < 0.05, false) AS drifted FROM chi_test
    """,
)
def category_drift(spark, sf):
    return rounded(dr.category_drift(_halves(spark, sf, "event_type"), "event_type"), 6, psi=9)


AREA = """
  , area AS (SELECT feature, round(coalesce(sum(abs(cum_ref::DOUBLE / n_ref - cum_cur::DOUBLE / n_cur)
                                                * (next - value)), 0), 6) AS wasserstein FROM frame GROUP BY feature)
"""
REPORT = (
    SHIFTED
    + _frame_sql("long", "feature")
    + _ks_sql("feature")
    + AREA
    + f", bins AS (SELECT * FROM (WITH unused AS (SELECT 1) {PSI.format(g='feature')}))"
    + " SELECT result.*, psi, wasserstein FROM result JOIN bins USING (feature) JOIN area USING (feature)"
)


@query("drift_report", REPORT)
def drift_report(spark, sf):
    """Every distance of every column from one read of the table."""
    return rounded(dr.drift_report(_shifted(spark, sf), MEASURES))


@query("profile_drift", REPORT)
def profile_drift(spark, sf):
    """The same from stored counts of the reference: only the current side is read again."""
    df = _shifted(spark, sf)
    known = dr.reference_counts(df.where("side = 'reference'"), MEASURES, "v1")
    return rounded(dr.drift_from_profile(known, df.where("side = 'current'"), MEASURES))


@query(
    "mixed_dataset_drift",
    HALVES
    + ", long AS (SELECT 'value' AS feature, value, side FROM h)"
    + _frame_sql("long", "feature")
    + _ks_sql("feature").replace("result AS", "numbers AS")
    + CATEGORIES
    + ", result AS (SELECT drifted FROM numbers UNION ALL SELECT coalesce(chi_p < 0.05, false) FROM chi_test)"
    + ROLLUP,
)
def mixed_dataset_drift(spark, sf):
    """A number and a class in one roll-up."""
    sides = _halves(spark, sf, "event_type")
    return rounded(dr.dataset_drift(dr.mixed_drift(sides, ["value"], ["event_type"])))


@query(
    "label_drift",
    HALVES
    + """
    , r AS (SELECT count(*) FILTER (WHERE label = 1) AS x0, count(*) AS n0 FROM h WHERE side = 'reference'),
    d AS (SELECT date_trunc('day', ts) AS period, count(*) AS n, count(*) FILTER (WHERE label = 1) AS x
          FROM h GROUP BY period),
    z AS (SELECT *, (x + x0)::DOUBLE / (n + n0) AS p FROM d, r)
    SELECT period, n, x AS n_positive, round(x::DOUBLE / n, 6) AS rate,
           round((x::DOUBLE / n - x0::DOUBLE / n0) / sqrt(p * (1 - p) * (1.0::DOUBLE / n + 1.0::DOUBLE / n0)), 6) AS z
    FROM z
    """,
)
def label_drift(spark, sf):
    return rounded(dr.label_drift(_halves(spark, sf, "label"), "label", "day", LOG))


@query(
    "consecutive_alert",
    """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS m FROM events GROUP BY ALL),
         f AS (SELECT event_type, day, day - CAST(row_number() OVER (PARTITION BY event_type ORDER BY day) AS INTEGER)
                      AS island FROM d WHERE m > 48)
    SELECT event_type, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days
    FROM f GROUP BY event_type, island HAVING count(*) >= 2
    """,
)
def consecutive_alert(spark, sf):
    df = events(spark, sf)
    daily = df.groupBy("event_type", truncated(df, "ts", "day").alias("day")).agg(F.avg("value").alias("m"))
    return dr.consecutive_alert(daily.withColumn("alarm", F.col("m") > 48), ["event_type"], "day", "alarm", 2)


CONCEPT = (
    """
    WITH p AS (SELECT event_id, user_id, ts, value / 500.0::DOUBLE AS score FROM events WHERE event_type = 'purchase'),
         e AS (SELECT user_id, ts AS lts FROM events WHERE event_type = 'error'),
         j AS (SELECT p.*, CAST(coalesce(e.lts <= p.ts + INTERVAL 1 DAY, false) AS INTEGER) AS label
               FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts <= e.lts),
         s AS (SELECT date_trunc('day', ts) AS period, label, score FROM j),
         g AS (SELECT period, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
               FROM s GROUP BY ALL),
         c AS (SELECT *, sum(pos) OVER (PARTITION BY period ORDER BY score DESC
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp FROM g),
         a AS (SELECT period, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
                 round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) END AS roc_auc
               FROM c GROUP BY period),
         k AS (SELECT period, count(*) FILTER (WHERE label = 1 AND score >= 0.1) AS tp,
                      count(*) FILTER (WHERE label = 0 AND score >= 0.1) AS fp,
                      count(*) FILTER (WHERE label = 1 AND score < 0.1) AS fn,
                      count(*) FILTER (WHERE label = 0 AND score < 0.1) AS tn FROM s GROUP BY period)
    SELECT k.period, """
    + RATES
    + ", roc_auc FROM k JOIN a ON k.period = a.period"
)


@query("concept_drift", CONCEPT)
def concept_drift(spark, sf):
    """Score every purchase, label it by an error of the same user within a day, then rate each day.

    The label is looked up with a forward as-of join, so one prediction meets one label at most.
    """
    df = events(spark, sf)
    made = df.where("event_type = 'purchase'").select("user_id", "ts", (F.col("value") / 500.0).alias("score"))
    late = df.where("event_type = 'error'").select("user_id", "ts", F.lit(1).alias("hit"))
    source = st.Source(late, LOG, ("hit",), timedelta(days=1))
    joined = st.asof_join(made, [source], LOG, direction="forward").withColumn("label", F.coalesce("hit", F.lit(0)))
    daily = written(joined.select(truncated(joined, "ts", "day").alias("period"), "label", "score"), "labelled")
    return rounded(ev.classification_report(daily, "label", "score", 0.1, ["period"]).drop("aucpr"))


@query(
    "reference_profile",
    PERIODS
    + "SELECT 'v1' AS version, feature, count(*) AS n, round(avg(value), 6) AS mean, "
    "round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max, "
    + ", ".join(f"round(quantile_cont(value, 0.{i}), 6) AS edge_{i}" for i in range(1, 10))
    + " FROM long WHERE side = 'reference' GROUP BY feature",
)
def reference_profile(spark, sf):
    return rounded(dr.reference_profile(_periods(spark, sf).where("side = 'reference'"), MEASURES, "v1"))


@query(
    "seasonal_drift",
    HALVES
    + ", long AS (SELECT CAST(hour(ts) AS INTEGER) AS season, 'value' AS feature, value, side FROM h)"
    + _frame_sql("long", "season, feature")
    + _ks_sql("season, feature")
    + " SELECT * FROM result",
)
def seasonal_drift(spark, sf):
    """Every hour of the day has its own reference."""
    df = _halves(spark, sf)
    return rounded(dr.ks_drift(df.withColumn("season", F.hour("ts")), ["value"], ["season"]))


@query(
    "seasonal_psi",
    HALVES
    + ", long AS (SELECT dayofweek(ts)::INTEGER + 1 AS season, 'value' AS feature, value, side FROM h)"
    + _frame_sql("long", "season, feature")
    + PSI.format(g="season, feature"),
)
def seasonal_psi(spark, sf):
    df = _halves(spark, sf)
    return rounded(dr.psi(df.withColumn("season", F.dayofweek("ts")), ["value"], ["season"]))


@query(
    "retrain_decision",
    SHIFTED
    + _frame_sql("long", "feature")
    + _ks_sql("feature")
    + f"""
    , roll AS ({ROLLUP}), s AS ({SCORED_SQL}), p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM s),
    f AS (SELECT {RATES} FROM (SELECT {CONFUSION} FROM p))
    , d AS (SELECT count(*) <> count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS new_data FROM events)
    SELECT dataset_drift, f1 < 0.7 AS gate_failed, new_data, dataset_drift OR f1 < 0.7 OR new_data AS retrain FROM roll, f, d
    """,
)
def retrain_decision(spark, sf):
    """Drifted columns, the F1 gate, and whether the event table changed since its first half."""
    rolled = dr.dataset_drift(dr.ks_drift(_shifted(spark, sf), MEASURES))
    gate = ev.quality_gate(ev.metrics_long(ev.classification_report(scored(spark, sf), "label", "score")))
    log = events(spark, sf)
    then = log.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    marks = [fingerprint(d).select(F.lit(n).alias("v"), "version") for d, n in ((then, "old"), (log, "new"))]
    both = marks[0].unionByName(marks[1]).agg(
        *[F.max(F.when(F.col("v") == n, F.col("version"))).alias(n) for n in ("old", "new")]
    )
    return dr.retrain_decision(rolled, gate, both)


@query(
    "retrain_not_needed",
    PERIODS
    + _frame_sql("long", "feature")
    + _ks_sql("feature")
    + f"""
    , roll AS ({ROLLUP}), s AS ({SCORED_SQL}), p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM s),
    f AS (SELECT {RATES} FROM (SELECT {CONFUSION} FROM p)),
    d AS (SELECT count(*) <> count(*) FILTER (WHERE ts < TIMESTAMP '2034-01-01') AS new_data FROM events)
    SELECT dataset_drift, f1 < 0.1 AS gate_failed, new_data, dataset_drift OR f1 < 0.1 OR new_data AS retrain FROM roll, f, d
    """,
)
def retrain_not_needed(spark, sf):
    """The same decision where no column drifts, the gate is low and the table is the one last trained on."""
    rolled = dr.dataset_drift(dr.ks_drift(_periods(spark, sf), MEASURES))
    report = ev.metrics_long(ev.classification_report(scored(spark, sf), "label", "score"))
    log = events(spark, sf)
    then = log.where(F.col("ts") < F.lit("2034-01-01").cast("timestamp_ntz"))
    marks = [fingerprint(d).select(F.lit(n).alias("v"), "version") for d, n in ((then, "old"), (log, "new"))]
    both = marks[0].unionByName(marks[1]).agg(
        *[F.max(F.when(F.col("v") == n, F.col("version"))).alias(n) for n in ("old", "new")])
    return dr.retrain_decision(rolled, ev.quality_gate(report, "f1", 0.1), both)


SNAPSHOT = "2024-01-11"
ROLLING = f"""
  WITH l AS (SELECT ts, unnest(['value', 'user_id']) AS feature, unnest([value::DOUBLE, user_id::DOUBLE]) AS value FROM events),
       c AS (SELECT feature, value, date_trunc('hour', ts) + (24 - i) * INTERVAL 1 HOUR AS tick
             FROM l, (SELECT unnest(range(24)) AS i) WHERE ts >= TIMESTAMP '{SNAPSHOT}'),
       long AS (SELECT feature, tick, value, 'current' AS side FROM c
                UNION ALL SELECT t.feature, t.tick, l.value, 'reference'
                FROM (SELECT DISTINCT feature, tick FROM c) t JOIN l USING (feature) WHERE l.ts < TIMESTAMP '{SNAPSHOT}')
""" + _frame_sql("long", "feature, tick") + _ks_sql("feature, tick") + """
  SELECT feature, tick, n_ref, n_cur, statistic, p_value, drifted FROM result
"""


def _snapshot_grids(spark, sf):
    reference = events(spark, sf).where(F.col("ts") < F.lit(SNAPSHOT).cast("timestamp_ntz"))
    return ro.reference_grids(reference, ["value", "user_id"], cells=20_000)


@query("rolling_drift", ROLLING)
def rolling_drift(spark, sf):
    """Every hour, the last 24 hours against a training snapshot."""
    log = events(spark, sf).where(F.col("ts") >= F.lit(SNAPSHOT).cast("timestamp_ntz"))
    return rounded(ro.rolling_drift(log, _snapshot_grids(spark, sf)))


@query("stream_rolling_drift", ROLLING)
def stream_rolling_drift(spark, sf):
    """The hourly drift job on the log as a stream."""
    grids = _snapshot_grids(spark, sf)
    stream = jobs.file_stream(spark, sf, events(spark, sf).schema, "events.parquet")
    last = events(spark, sf).agg(F.max("ts")).first()[0]
    ending = jobs.Ending(stream, last - (last - datetime.min) % ro.STEP + dr.CURRENT_WINDOW)
    log = ending.watermarked(stream).where(F.col("ts") >= F.lit(SNAPSHOT).cast("timestamp_ntz").cast("timestamp"))
    return rounded(jobs.run_to_table(ro.rolling_drift_stream(log, grids), "rolling-drift", ending))


@query("stream_concept_drift", CONCEPT)
def stream_concept_drift(spark, sf):
    """Purchases and errors as two streams: each purchase is labelled as soon as an error of its user arrives, or as 0
    once a day has passed on both streams; then every day is rated."""
    rows = events(spark, sf)
    horizon = timedelta(days=1)
    end = rows.agg(F.max("ts")).first()[0] + horizon + timedelta(hours=1)
    sides = [jobs.file_stream(spark, sf, rows.schema, "events.parquet") for _ in range(2)]
    endings = [jobs.Ending(s, end) for s in sides]
    made, late = [e.watermarked(s) for e, s in zip(endings, sides)]
    made = made.where("event_type = 'purchase'").select("event_id", "user_id", "ts", (F.col("value") / 500.0).alias("score"))
    late = late.where("event_type = 'error'").select("user_id", "ts")
    joined = label_feedback(made, late, ["user_id"], ["event_id"], horizon, delay=None, label_delay=None)
    labelled = jobs.run_to_table(joined, "feedback", *endings)
    daily = labelled.select(truncated(labelled, "ts", "day").alias("period"), "label", "score")
    return rounded(ev.classification_report(daily, "label", "score", 0.1, ["period"]).drop("aucpr"))


@query(
    "shared_column_drift",
    PERIODS + _frame_sql("long", "feature") + _ks_sql("feature")
    + " SELECT * FROM result WHERE feature IN ('l_quantity', 'l_extendedprice', 'l_discount')",
)
def shared_column_drift(spark, sf):
    """Columns nobody names: the numbers that both tables have, without keys, time and label."""
    sides = _periods(spark, sf).withColumn("l_partkey", F.lit(1))
    reference = sides.where("side = 'reference'").drop("side").withColumn("only_here", F.lit(1))
    current = sides.where("side = 'current'").drop("side")
    columns = dr.monitored_columns(reference, current, contract=LINES, label="l_tax", numeric=True)
    return rounded(dr.ks_drift(dr.stack_sides(reference, current, columns), columns))
