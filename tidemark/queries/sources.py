"""Scans, derived tables and table versions."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.contract import Contract
from tidemark.functions.times import truncated
from tidemark.operators import features as fx
from tidemark.operators.quality import validate_manifest
from tidemark.operators.splits import temporal_split
from tidemark.operators.store import latest_rows
from tidemark.plans.scratch import fresh_path
from tidemark.queries.base import LOG, events, labelled, rounded
from tidemark.session import table
from tidemark.sources import tables as tb
from tidemark.sources import versions as vs
from tidemark.sources.trees import TreeStore


@query(
    "scan_sensors",
    """
    SELECT CAST(user_id AS VARCHAR) AS machine_id, ts AS event_timestamp, value AS temperature,
           CAST(event_type = 'error' AS INTEGER) AS failure
    FROM events
    """,
)
def scan_sensors(spark, sf):
    rows = tb.read_sensors(spark, source=f"{sf}/events.parquet", schema=events(spark, sf).schema)
    return rows.select(
        F.col("user_id").cast("string").alias("machine_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("temperature"),
        (F.col("event_type") == "error").cast("int").alias("failure"),
    )


@query(
    "path_manifest",
    """
    WITH p AS (SELECT url, string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS parts FROM pages)
    SELECT url AS image_path, CASE WHEN len(parts) >= 2 THEN parts[len(parts) - 1] ELSE 'unknown' END AS label,
           CASE WHEN len(parts) >= 3 THEN parts[1] ELSE 'unknown' END AS split
    FROM p
    """,
)
def path_manifest(spark, sf):
    pages = table(spark, sf, "pages").select("url")
    return tb.manifest_from_paths(pages, "url", F.regexp_replace("url", "^[a-z]+://", ""), endings=None)


@query(
    "daily_demand",
    """
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY day),
         g AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
    SELECT CAST(g.day AS TIMESTAMP) AS o_orderdate, coalesce(n, 0) AS demand FROM g LEFT JOIN d ON g.day = d.day
    """,
)
def daily_demand(spark, sf):
    return tb.daily_demand(table(spark, sf, "orders"), "o_orderdate")


@query(
    "feature_table",
    """
    SELECT user_id, ts, round(coalesce(avg(value) OVER w, 0.0), 6) AS value_roll_mean,
           CAST(event_type = 'error' AS INTEGER) AS label
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
    """,
)
def feature_table(spark, sf):
    feature = fx.Feature("value_roll_mean", "value", "mean", 3)
    made = fx.build_features(labelled(spark, sf).select("user_id", "ts", "value", "label"), [feature], LOG)
    return rounded(tb.feature_table(made, [feature.name], LOG, "label"))


@query(
    "feature_label_split",
    """
    WITH r AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS entity_id, ts, value,
                      CAST(event_type = 'error' AS INTEGER) AS label FROM events)
    SELECT entity_id, 'feature' AS part, ts, value AS x FROM r
    UNION ALL SELECT entity_id, 'label', ts + INTERVAL 1 HOUR, label::DOUBLE FROM r
    """,
)
def feature_label_split(spark, sf):
    rows = labelled(spark, sf).select("event_id", "ts", "value", "label")
    features, labels = tb.feature_label_split(rows, ["event_id"], ["value"], "label", "ts")
    parts = [
        features.select("entity_id", F.lit("feature").alias("part"), "ts", F.col("value").alias("x")),
        labels.select("entity_id", F.lit("label").alias("part"), "ts", F.col("label").cast("double").alias("x")),
    ]
    return parts[0].unionByName(parts[1])


@query("lake_layer", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def lake_layer(spark, sf):
    """The events written as an interim layer and read back."""
    path = tb.write_layer(events(spark, sf), fresh_path(spark, "lake"), "interim", "events")
    return spark.read.parquet(path)


@query(
    "stage_splits",
    """
    SELECT event_id, ts, CASE WHEN row_number() OVER (ORDER BY ts, user_id)
           <= count(*) OVER () - greatest(1, floor(count(*) OVER () * 0.2::DOUBLE)) THEN 'train' ELSE 'test' END
           AS split
    FROM events
    """,
)
def stage_splits(spark, sf):
    """The hold-out split written with one folder per split and read back."""
    path = fresh_path(spark, "splits")
    tb.write_splits(temporal_split(events(spark, sf), 0.2, contract=LOG).select("event_id", "ts", "split"), path)
    return spark.read.parquet(path)


@query(
    "cycle_align",
    """
    SELECT l_orderkey, CAST(l_suppkey AS VARCHAR) AS machine_id,
           TIMESTAMP '2024-01-01' + l_linenumber * INTERVAL 1 HOUR AS event_timestamp, l_quantity
    FROM lineitem
    """,
)
def cycle_align(spark, sf):
    aligned = tb.align_cycles(table(spark, sf, "lineitem"), "l_suppkey", "l_linenumber", datetime(2024, 1, 1))
    return aligned.select("l_orderkey", "machine_id", "event_timestamp", "l_quantity")


def _fingerprint_sql(source, columns):
    """The hash of a row, spelled out; ``columns`` maps names to Spark's types."""
    text = {"timestamp_ntz": "CAST(epoch_us({0}) AS VARCHAR)"}
    cells = [text.get(kind, "CAST({0} AS VARCHAR)").format(c) for c, kind in sorted(columns.items())]
    cells = " || ".join(f"coalesce(length({c}) || ':' || {c}, '~')" for c in cells)
    kinds = ",".join(f"{c} {kind}" for c, kind in sorted(columns.items()))
    parts = [f"sum(CAST(('0x' || substr(h, {at}, 12)) AS BIGINT))" for at in (1, 13)]
    return f"""
      SELECT count(*) AS n_rows, concat_ws('-', substr(md5('{kinds}'), 1, 8), count(*), {parts[0]}, {parts[1]}) AS version
      FROM (SELECT md5({cells}) AS h FROM {source})
    """


EVENT_COLUMNS = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double",
    "props": "string",
}


@query("table_fingerprint", _fingerprint_sql("events", EVENT_COLUMNS))
def table_fingerprint(spark, sf):
    return vs.fingerprint(events(spark, sf))


VERSIONS = """
  WITH v1 AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'),
       v2 AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05')
"""


def _versions(spark, sf):
    log = events(spark, sf)
    first = log.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    second = log.where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
    return [first, second]


@query(
    "version_diff",
    VERSIONS
    + """
    SELECT *, 'added' AS change FROM (SELECT * FROM v2 EXCEPT ALL SELECT * FROM v1)
    UNION ALL SELECT *, 'removed' FROM (SELECT * FROM v1 EXCEPT ALL SELECT * FROM v2)
    """,
)
def version_diff(spark, sf):
    return vs.diff(*_versions(spark, sf))


@query("version_unchanged", VERSIONS + "SELECT * FROM v1 INTERSECT ALL SELECT * FROM v2")
def version_unchanged(spark, sf):
    return vs.unchanged(*_versions(spark, sf))


@query(
    "latest_hourly_rows",
    """
    SELECT user_id, max(hour) AS hour, arg_max(value, (hour, event_id)) AS value
    FROM (SELECT *, date_trunc('hour', ts) AS hour FROM events) GROUP BY user_id
    """,
)
def latest_hourly_rows(spark, sf):
    """Latest row per entity when times repeat: the tie column decides."""
    df = events(spark, sf)
    df = df.withColumn("hour", truncated(df, "ts", "hour"))
    return latest_rows(df, ["value"], Contract(("user_id",), "hour", ("event_id",)))


EDITED = """
  WITH v2 AS (SELECT event_id, user_id, ts, event_type, value + CASE WHEN ts::DATE = DATE '2024-01-07' THEN 1.0 ELSE 0 END AS value
              FROM events WHERE NOT (ts::DATE = DATE '2024-01-05' AND event_type = 'error')),
       v1 AS (SELECT event_id, user_id, ts, event_type, value FROM events)
"""


def _saved_twice(spark, sf):
    """The event log and an edited copy in one store, by days: (store, roots)."""
    df = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    day = F.to_date("ts")
    on = lambda d: day == F.lit(d).cast("date")
    edited = df.where(~(on("2024-01-05") & (F.col("event_type") == "error")))
    edited = edited.withColumn("value", F.col("value") + F.when(on("2024-01-07"), 1.0).otherwise(0.0))
    store = TreeStore(spark, fresh_path(spark, "store"), day)
    return store, [store.save(v).root for v in (df, edited)]


@query("version_restore", "SELECT event_id, user_id, ts, event_type, value FROM events")
def version_restore(spark, sf):
    """The first of two versions that share most of their parts."""
    store, (first, _) = _saved_twice(spark, sf)
    return store.restore(first)


@query(
    "version_parts",
    EDITED
    + """
    SELECT ts::DATE::VARCHAR AS part, count(*) AS n_old,
           count(*) FILTER (WHERE NOT (ts::DATE = DATE '2024-01-05' AND event_type = 'error')) AS n_new
    FROM events WHERE ts::DATE IN (DATE '2024-01-05', DATE '2024-01-07') GROUP BY ts::DATE
    HAVING n_old <> n_new OR ts::DATE = DATE '2024-01-07'
    """,
)
def version_parts(spark, sf):
    """The days in which two versions differ, without reading the rows of either."""
    store, roots = _saved_twice(spark, sf)
    return store.changed_parts(*roots).select(F.col("__part").alias("part"), "n_old", "n_new")


@query(
    "version_tree_diff",
    EDITED
    + """
    SELECT *, 'added' AS change FROM (SELECT * FROM v2 EXCEPT ALL SELECT * FROM v1)
    UNION ALL SELECT *, 'removed' FROM (SELECT * FROM v1 EXCEPT ALL SELECT * FROM v2)
    """,
)
def version_tree_diff(spark, sf):
    store, roots = _saved_twice(spark, sf)
    return store.diff(*roots)


@query("scan_csv", "SELECT event_id, user_id, ts, event_type, value FROM events")
def scan_csv(spark, sf):
    """The event log from CSV files whose columns stand in another order, beside one that nobody asked for."""
    df = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    path = fresh_path(spark, "sensors") + ".csv"
    turned = df.select("value", F.lit("x").alias("note"), "event_type", F.col("ts").cast("string").alias("ts"), "user_id", "event_id")
    turned.write.option("header", True).csv(path)
    return tb.read_sensors(spark, {"data": {"source": path}}, schema=df.schema)


@query(
    "scan_cycles",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS machine_id, TIMESTAMP '2024-01-01' + l_linenumber * INTERVAL 1 HOUR AS event_timestamp,
           l_quantity, l_discount FROM lineitem
    """,
)
def scan_cycles(spark, sf):
    """Run-to-failure text: unit, cycle and readings between blanks, without a header."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"]
    lines = table(spark, sf, "lineitem").select(F.concat_ws("  ", *[F.col(c).cast("string") for c in columns]).alias("value"))
    path = fresh_path(spark, "cycles")
    lines.select(F.concat(F.lit(" "), "value", F.lit(" ")).alias("value")).write.text(path)
    rows = tb.read_cycles(spark, path, columns, datetime(2024, 1, 1))
    return rows.select("machine_id", "event_timestamp", "l_quantity", "l_discount")


@query(
    "manifest_counts",
    """
    WITH p AS (SELECT string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS parts FROM pages)
    SELECT CASE WHEN len(parts) >= 2 THEN parts[len(parts) - 1] ELSE 'unknown' END AS label,
           CASE WHEN len(parts) >= 3 THEN parts[1] ELSE 'unknown' END AS split, count(*) AS n
    FROM p GROUP BY ALL
    """,
)
def manifest_counts(spark, sf):
    """A manifest that has passed its check (columns there, not empty), counted by split and label."""
    return validate_manifest(path_manifest(spark, sf), allow_empty=False).groupBy("label", "split").agg(
        F.count(F.lit(1)).alias("n"))
