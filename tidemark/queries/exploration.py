"""Exploratory aggregates."""

from tidemark.catalog import query
from tidemark.operators import exploration as ex
from tidemark.operators.splits import hash_split
from tidemark.queries.base import LOG, events, labelled, rounded
from tidemark.queries.splits import SHARE
from tidemark.session import table

COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
TYPES = {"l_linenumber": "int"}


@query(
    "describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,
                   round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
                   round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
                   round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, '{TYPES.get(c, "double")}' AS dtype
            FROM lineitem"""
        for c in COLUMNS
    ),
)
def describe(spark, sf):
    return rounded(ex.describe(table(spark, sf, "lineitem"), COLUMNS))


@query("class_balance", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def class_balance(spark, sf):
    return ex.value_counts(events(spark, sf), "event_type")


@query(
    "entity_summary",
    """
    SELECT user_id, count(*) AS n, round(avg(CAST(event_type = 'error' AS INTEGER)), 6) AS label_rate,
           round(avg(value), 6) AS mean_value FROM events GROUP BY user_id
    """,
)
def entity_summary(spark, sf):
    return rounded(ex.entity_summary(labelled(spark, sf), ["value"], "label", ["user_id"]))


@query(
    "means_by_label",
    """
    SELECT l_returnflag, round(avg(l_quantity), 6) AS mean_l_quantity,
           round(avg(l_extendedprice), 4) AS mean_l_extendedprice, round(avg(l_discount), 6) AS mean_l_discount
    FROM lineitem GROUP BY l_returnflag
    """,
)
def means_by_label(spark, sf):
    made = ex.means_by(table(spark, sf, "lineitem"), COLUMNS[1:], ["l_returnflag"])
    return rounded(made, 6, mean_l_extendedprice=4)


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, "
        f"round(corr({min(a, b, key=COLUMNS.index)}, {max(a, b, key=COLUMNS.index)}), 6) AS correlation FROM lineitem"
        for a in COLUMNS
        for b in COLUMNS
        if a != b
    )
    + "".join(f" UNION ALL SELECT '{a}', '{a}', 1.0::DOUBLE" for a in COLUMNS),
)
def corr_matrix(spark, sf):
    return rounded(ex.corr_matrix(table(spark, sf, "lineitem"), COLUMNS))


@query(
    "class_histogram",
    """
    WITH r AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type)
    SELECT e.event_type, CAST(least(14, floor((value - lo) / (hi - lo) * 15)) AS INTEGER) AS bin, count(*) AS n
    FROM events e JOIN r ON e.event_type = r.event_type GROUP BY ALL
    """,
)
def class_histogram(spark, sf):
    return ex.class_histogram(events(spark, sf), "value", "event_type")


@query(
    "split_label_counts",
    f"""
    WITH d AS (SELECT lang, CASE WHEN {SHARE.format(key="doc_id")} < 0.2 THEN 'test' ELSE 'train' END AS split
               FROM documents)
    SELECT CASE WHEN grouping(split) = 1 THEN '*' ELSE split END AS split,
           CASE WHEN grouping(lang) = 1 THEN '*' ELSE lang END AS lang, count(*) AS n
    FROM d GROUP BY CUBE (split, lang)
    """,
)
def split_label_counts(spark, sf):
    split = hash_split(table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 0.2)
    return ex.split_label_counts(split, "split", "lang")


@query(
    "extent",
    """
    SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_entities, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events
    """,
)
def extent(spark, sf):
    return ex.extent(events(spark, sf), LOG)
