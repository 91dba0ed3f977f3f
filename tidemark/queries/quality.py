"""Cleaning and contract checks."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.contract import Contract
from tidemark.functions.times import truncated
from tidemark.operators import quality as q
from tidemark.queries.base import LOG, events, labelled, rounded
from tidemark.session import table


@query(
    "dedup_first",
    """
    SELECT user_id, date_trunc('hour', ts) AS hour, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) = 1
    """,
)
def dedup_first(spark, sf):
    df = events(spark, sf).select("user_id", "event_id", "ts", "value")
    df = df.withColumn("hour", truncated(df, "ts", "hour"))
    return q.dedup_first(df, Contract(("user_id",), "hour", ("ts", "event_id")))


def _with_gaps(spark, sf):
    """Events where low readings are missing and every tenth user reports text."""
    k = F.get_json_object("props", "$.k")
    return events(spark, sf).select(
        "user_id",
        "ts",
        "event_type",
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        F.when(F.col("user_id") % 10 == 0, F.lit("n/a")).otherwise(k).alias("k"),
    )


GAPS = """
  WITH g AS (SELECT user_id, ts, event_type, CASE WHEN value >= 5 THEN value END AS value,
                    CASE WHEN user_id % 10 = 0 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS k
             FROM events)
"""


@query(
    "null_counts",
    GAPS
    + """
    SELECT 'user_id' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE user_id IS NULL) AS n_null FROM g
    UNION ALL SELECT 'ts', count(*), count(*) FILTER (WHERE ts IS NULL) FROM g
    UNION ALL SELECT 'value', count(*), count(*) FILTER (WHERE value IS NULL) FROM g
    """,
)
def null_counts(spark, sf):
    return q.null_counts(_with_gaps(spark, sf), ["user_id", "ts", "value"])




def _suite_line(rule, column, condition):
    return f"""
    SELECT '{rule}' AS rule, '{column}' AS "column", count(*) AS n_rows,
           count(*) FILTER (WHERE {condition}) AS n_broken,
           min(CAST({column} AS VARCHAR)) FILTER (WHERE {condition}) AS example,
           count(*) FILTER (WHERE {condition}) = 0 AS passed FROM g
    """


NON_EMPTY = """
    SELECT 'non_empty' AS rule, '*' AS "column", count(*) AS n_rows,
           greatest(1 - count(*), 0) AS n_broken, CAST(NULL AS VARCHAR) AS example, count(*) >= 1 AS passed FROM g
"""


@query(
    "range_violations",
    GAPS
    + NON_EMPTY
    + " UNION ALL "
    + _suite_line("in_range", "value", "value < 0 OR value > 250")
    + " UNION ALL "
    + _suite_line("in_range", "k", "TRY_CAST(k AS DOUBLE) < 10 OR TRY_CAST(k AS DOUBLE) > 90"),
)
def range_violations(spark, sf):
    return q.check(_with_gaps(spark, sf), [q.in_range("value", 0, 250), q.in_range("k", 10, 90)])


@query(
    "domain_violations",
    """
    SELECT event_type, count(*) AS n_rows FROM events
    WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type
    """,
)
def domain_violations(spark, sf):
    return q.unexpected_values(events(spark, sf), "event_type", ["view", "click", "purchase"])


@query(
    "label_rate",
    """
    SELECT count(*) AS n_rows, round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS rate,
           count(DISTINCT event_type = 'error') < 2 AS degenerate FROM events
    """,
)
def label_rate(spark, sf):
    return rounded(q.label_rate(labelled(spark, sf), "label"))


@query(
    "monotonic_check",
    """
    SELECT user_id, count(*) AS n_rows, count(*) FILTER (WHERE ts < prev) AS n_backward,
           count(*) FILTER (WHERE ts < prev) = 0 AS monotonic
    FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY value, event_id) AS prev FROM events)
    GROUP BY user_id
    """,
)
def monotonic_check(spark, sf):
    """Arrival order is by reading here, so that out-of-order rows exist."""
    return q.backward_steps(events(spark, sf), ["value", "event_id"], LOG)


@query(
    "duplicate_keys",
    """
    SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n_rows FROM events
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def duplicate_keys(spark, sf):
    df = events(spark, sf)
    return q.duplicate_keys(df.select("user_id", truncated(df, "ts", "hour").alias("hour")), ["user_id", "hour"])


@query(
    "quarantine",
    GAPS
    + """
    SELECT user_id, ts, value, k, concat_ws('|', CASE WHEN value IS NULL THEN 'not_null:value' END,
           CASE WHEN value > 200 THEN 'in_range:value' END,
           CASE WHEN TRY_CAST(k AS DOUBLE) > 90 THEN 'in_range:k' END) AS reasons
    FROM g WHERE value IS NULL OR value > 200 OR TRY_CAST(k AS DOUBLE) > 90
    """,
)
def quarantine(spark, sf):
    rules = [q.not_null("value"), q.in_range("value", 0, 200), q.in_range("k", 0, 90)]
    rejected = q.quarantine(_with_gaps(spark, sf), rules)[1]
    return rejected.select("user_id", "ts", "value", "k", F.concat_ws("|", "reasons").alias("reasons"))


@query(
    "batch_size_check",
    """
    SELECT conv_id, count(*) AS n_items, count(*) BETWEEN 1 AND 4 AS accepted FROM conversations GROUP BY conv_id
    """,
)
def batch_size_check(spark, sf):
    return q.batch_sizes(table(spark, sf, "conversations"), ["conv_id"], (1, 4))


@query(
    "expectation_suite",
    GAPS
    + NON_EMPTY
    + "".join(
        " UNION ALL " + _suite_line(*line)
        for line in (
            ("not_null", "user_id", "user_id IS NULL"),
            ("in_range", "value", "value < -50 OR value > 250"),
            ("in_set", "event_type", "event_type NOT IN ('view', 'signup', 'error', 'click', 'purchase')"),
            ("positive", "value", "value <= 0"),
            ("is_double", "k", "k IS NOT NULL AND TRY_CAST(k AS DOUBLE) IS NULL"),
        )
    )
    + """
    UNION ALL SELECT 'not_null', 'value', count(*), count(*) FILTER (WHERE value IS NULL), NULL,
           count(*) FILTER (WHERE value IS NULL) <= 0.1 * count(*) FROM g
    UNION ALL SELECT 'exists', 'humidity', count(*), count(*), NULL, false FROM g
    """,
)
def expectation_suite(spark, sf):
    rules = [
        q.not_null("user_id"),
        q.not_null("value", 0.1),
        q.in_range("value", -50, 250),
        q.in_set("event_type", ["view", "signup", "error", "click", "purchase"]),
        q.positive("value"),
        q.castable("k", "double"),
        q.not_null("humidity"),
    ]
    return q.check(_with_gaps(spark, sf), rules)


@query(
    "densify_hourly",
    """
    WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour, avg(value) AS m FROM events GROUP BY ALL),
         e AS (SELECT user_id, min(hour) AS lo, max(hour) AS hi FROM h GROUP BY user_id),
         grid AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM e)
    SELECT g.user_id, g.hour, round(h.m, 6) AS mean_value, h.user_id IS NULL AS missing
    FROM grid g LEFT JOIN h ON h.user_id = g.user_id AND h.hour = g.hour
    """,
)
def densify_hourly(spark, sf):
    return rounded(q.densify_hourly(events(spark, sf), "value", LOG))


@query(
    "downsample_hourly",
    """
    SELECT user_id, date_trunc('hour', ts) AS bucket, count(*) AS n, round(avg(value), 6) AS mean_value,
           min(value) AS min_value, max(value) AS max_value, arg_max(value, ts) AS last_value
    FROM events GROUP BY ALL
    """,
)
def downsample_hourly(spark, sf):
    return rounded(q.downsample(events(spark, sf), "value", "1 hour", LOG))


@query("drop_outliers", "SELECT event_id, user_id, ts, value FROM events WHERE value BETWEEN 1 AND 200")
def drop_outliers(spark, sf):
    return q.drop_outliers(events(spark, sf), {"value": (1, 200)}).select("event_id", "user_id", "ts", "value")


@query(
    "label_rates_by_user",
    """
    SELECT user_id, count(*) AS n_rows, round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS rate,
           count(DISTINCT event_type = 'error') < 2 AS degenerate FROM events GROUP BY user_id
    """,
)
def label_rates_by_user(spark, sf):
    """Users of which some have never failed, or always: one class is no training set."""
    return rounded(q.label_rate(labelled(spark, sf), "label", ["user_id"]))


@query(
    "request_quarantine",
    """
    SELECT event_id, concat_ws(' ', CASE WHEN user_id IS NULL THEN 'not_null:user_id' END,
                               CASE WHEN value IS NULL THEN 'not_null:value' END,
                               CASE WHEN value NOT BETWEEN 1 AND 60 THEN 'in_range:value' END) AS reasons FROM events WHERE value NOT BETWEEN 1 AND 60 OR value IS NULL OR user_id IS NULL
    """,
)
def request_quarantine(spark, sf):
    """Readings that a scoring request may not hold, with the rules they break."""
    rules = q.request_rules("user_id", {"value": (1, 60)})
    return q.with_reasons(events(spark, sf), rules).where(F.size("reasons") > 0).select(
        "event_id", F.array_join("reasons", " ").alias("reasons"))


@query(
    "column_roles",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n FROM lineitem"
                       for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_tax")),
)
def column_roles(spark, sf):
    """The number columns of lineitem that are neither keys nor the label (the discount), each with its rows."""
    lines = table(spark, sf, "lineitem")
    roles = q.feature_roles(lines, "l_discount", ["l_orderkey", "l_partkey", "l_suppkey"])
    counts = lines.agg(*[F.count(c).alias(c) for c in roles])
    return counts.unpivot([], roles, "feature", "n")
