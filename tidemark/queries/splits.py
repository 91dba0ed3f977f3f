"""Splits of the event log, the orders table and the documents."""

from tidemark.catalog import query
from tidemark.contract import Contract
from tidemark.operators import splits as sp
from tidemark.queries.base import LOG, events, labelled, rounded
from tidemark.session import table

ORDERS = Contract(("o_custkey",), "o_orderdate", ("o_orderkey",))
SHARE = "CAST('0x' || substr(md5({key} || '|42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


@query(
    "temporal_split",
    """
    WITH r AS (SELECT o_orderkey, o_orderdate,
                      row_number() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS i,
                      count(*) OVER () AS n FROM orders),
         z AS (SELECT *, greatest(1, floor(n * 0.2::DOUBLE)) AS n_test, greatest(1, floor(n * 0.1::DOUBLE)) AS n_val
               FROM r)
    SELECT o_orderkey, o_orderdate, CASE WHEN i <= greatest(1, n - n_test - n_val) THEN 'train'
           WHEN i <= greatest(1, n - n_test - n_val) + n_val THEN 'val' ELSE 'test' END AS split FROM z
    """,
)
def temporal_split(spark, sf):
    """Order dates repeat heavily, so both borders fall inside a day."""
    made = sp.temporal_split(table(spark, sf, "orders"), 0.2, 0.1, ORDERS)
    return made.select("o_orderkey", "o_orderdate", "split")


@query(
    "temporal_holdout",
    """
    SELECT event_id, ts, CASE WHEN row_number() OVER (ORDER BY ts, user_id)
           <= count(*) OVER () - greatest(1, floor(count(*) OVER () * 0.2::DOUBLE)) THEN 'train' ELSE 'test' END
           AS split
    FROM events
    """,
)
def temporal_holdout(spark, sf):
    return sp.temporal_split(events(spark, sf), 0.2, contract=LOG).select("event_id", "ts", "split")


@query(
    "stratified_split",
    f"""
    WITH r AS (SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS n,
                      row_number() OVER (PARTITION BY event_type
                                         ORDER BY {SHARE.format(key="event_id")}, event_id) AS i FROM events)
    SELECT event_id, event_type, CASE WHEN i <= round(n * 0.3::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM r
    """,
)
def stratified_split(spark, sf):
    made = sp.stratified_split(events(spark, sf).select("event_id", "event_type"), "event_type", ["event_id"], 0.3)
    return made


@query(
    "hash_split",
    f"""
    SELECT doc_id, lang, CASE WHEN {SHARE.format(key="doc_id")} < 0.2 THEN 'test' ELSE 'train' END AS split
    FROM documents
    """,
)
def hash_split(spark, sf):
    return sp.hash_split(table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 0.2)


@query(
    "group_split",
    f"""
    SELECT event_id, user_id, CASE WHEN {SHARE.format(key="user_id")} < 0.2 THEN 'test' ELSE 'train' END AS split
    FROM events
    """,
)
def group_split(spark, sf):
    return sp.hash_split(events(spark, sf).select("event_id", "user_id"), ["user_id"], 0.2)


@query(
    "ref_current_split",
    """
    SELECT user_id, ts, value, CASE WHEN row_number() OVER (ORDER BY ts, user_id) <= count(*) OVER () // 2
           THEN 'reference' ELSE 'current' END AS side
    FROM events
    """,
)
def ref_current_split(spark, sf):
    return sp.reference_current(events(spark, sf), ["value"], LOG)


@query(
    "kfold_assign",
    f"SELECT event_id, CAST(floor({SHARE.format(key='event_id')} * 5) AS INTEGER) AS fold FROM events",
)
def kfold_assign(spark, sf):
    return sp.kfold(events(spark, sf).select("event_id"), ["event_id"])


@query(
    "class_weights",
    """
    SELECT CAST(event_type = 'error' AS INTEGER) AS label, count(*) AS n_class,
           round((SELECT count(*) FROM events) / 2.0 / count(*), 6) AS weight
    FROM events GROUP BY label
    """,
)
def class_weights(spark, sf):
    return rounded(sp.class_weights(labelled(spark, sf), "label"))


RANKED = f"""
  WITH r AS (SELECT event_id, event_type, value, count(*) OVER (PARTITION BY event_type) AS n,
                    row_number() OVER (PARTITION BY event_type ORDER BY {SHARE.format(key="event_id")}, event_id) AS i
             FROM events)
"""


@query(
    "resample_counts",
    RANKED
    + """
    , k AS (SELECT *, CASE event_type WHEN 'error' THEN 2500 WHEN 'click' THEN 40 END AS k FROM r),
    c AS (SELECT *, k // n + CASE WHEN i <= k % n THEN 1 ELSE 0 END AS copies FROM k WHERE k IS NOT NULL)
    SELECT event_id, event_type, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy FROM c
    """,
)
def resample_counts(spark, sf):
    """More errors than there are, and few clicks, both to the row."""
    df = events(spark, sf).select("event_id", "event_type")
    return sp.resample(df, "event_type", ["event_id"], {"error": 2500, "click": 40})


@query(
    "balanced_classes",
    RANKED
    + """
    , m AS (SELECT min(n) AS least FROM r)
    SELECT event_id, event_type, 1::INTEGER AS copy FROM r, m WHERE i <= least
    """,
)
def balanced_classes(spark, sf):
    return sp.balanced(events(spark, sf).select("event_id", "event_type"), "event_type", ["event_id"])
