"""Metrics over a scored table (documents with quality labels), lineitem prices and embeddings."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.exprs import argmax
from tidemark.operators import evaluation as ev
from tidemark.operators import features as fx
from tidemark.plans.scratch import written
from tidemark.plans.scratch import fresh_path
from tidemark.queries.base import LOG, SCORED_SQL, labelled, rounded, scored
from tidemark.session import table

S = f"WITH s AS ({SCORED_SQL}), p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM s)"
CONFUSION = """
  count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND predicted = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND predicted <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND predicted <> 1) AS tn
"""
RATES = """
  round(coalesce((tp + tn)::DOUBLE / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
  round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
"""
CURVE = """
  , g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
          FROM s GROUP BY score)
  , c AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM g
          WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""
AUC = "round((sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg))), 6)"
AP = "round(sum(pos * (tp::DOUBLE / (tp + fp))) / sum(pos)::DOUBLE, 6)"


@query("threshold_flag", S + " SELECT doc_id, label, predicted FROM p")
def threshold_flag(spark, sf):
    return ev.threshold_flag(scored(spark, sf), "score").select("doc_id", "label", "predicted")


@query("binary_metrics", f"{S} SELECT tp, fp, fn, tn, {RATES} FROM (SELECT {CONFUSION} FROM p)")
def binary_metrics(spark, sf):
    return rounded(ev.binary_metrics(ev.threshold_flag(scored(spark, sf), "score"), "label", "predicted"))


@query(
    "slice_metrics",
    f"""
    {S} SELECT lang, source, tp, fp, fn, tn, {RATES} FROM (
      SELECT CASE WHEN grouping(lang) = 1 THEN '*' ELSE lang END AS lang,
             CASE WHEN grouping(source) = 1 THEN '*' ELSE source END AS source, {CONFUSION}
      FROM p GROUP BY CUBE (lang, source))
    """,
)
def slice_metrics(spark, sf):
    flagged = ev.threshold_flag(scored(spark, sf), "score")
    return rounded(ev.slice_metrics(flagged, "label", "predicted", ["lang", "source"]))


@query("roc_auc", f"{S} {CURVE} SELECT {AUC} AS roc_auc FROM c")
def roc_auc(spark, sf):
    return rounded(ev.ranking_metrics(scored(spark, sf), "label", "score").select("roc_auc"))


@query("average_precision", f"{S} {CURVE} SELECT {AP} AS aucpr FROM c")
def average_precision(spark, sf):
    return rounded(ev.ranking_metrics(scored(spark, sf), "label", "score").select("aucpr"))


@query(
    "classification_report",
    f"""
    {S} {CURVE}, k AS (SELECT {CONFUSION} FROM p)
    SELECT {RATES}, (SELECT {AUC} FROM c) AS roc_auc, (SELECT {AP} FROM c) AS aucpr FROM k
    """,
)
def classification_report(spark, sf):
    return rounded(ev.classification_report(scored(spark, sf), "label", "score"))


@query(
    "roc_points",
    f"""
    {S} {CURVE} SELECT round(score, 9) AS threshold,
      round(fp::DOUBLE / (SELECT sum(neg) FROM g), 9) AS fpr, round(tp::DOUBLE / (SELECT sum(pos) FROM g), 9) AS tpr
    FROM c
    """,
)
def roc_points(spark, sf):
    return rounded(ev.roc_points(scored(spark, sf), "label", "score"), 9)


@query(
    "leak_gap",
    """
    WITH f AS (SELECT CAST(event_type = 'error' AS INTEGER) AS label, value AS leaky,
                      round(avg(value) OVER w, 9) AS honest
               FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)),
         l AS (SELECT 'leaky' AS side, label, leaky AS s FROM f WHERE honest IS NOT NULL
               UNION ALL SELECT 'honest', label, honest FROM f WHERE honest IS NOT NULL),
         g AS (SELECT side, s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
               FROM l GROUP BY side, s),
         c AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp FROM g
               WINDOW w AS (PARTITION BY side ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
         a AS (SELECT side, sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc
               FROM c GROUP BY side),
         w AS (SELECT max(auc) FILTER (WHERE side = 'leaky') AS x, max(auc) FILTER (WHERE side = 'honest') AS y FROM a)
    SELECT round(x, 6) AS auc_leaky, round(y, 6) AS auc_honest, round(x - y, 6) AS gap,
           round((x - y) / y, 6) AS relative_gap FROM w
    """,
)
def leak_gap(spark, sf):
    both = fx.leak_compare(labelled(spark, sf).select("user_id", "ts", "value", "label"), ["value"], 6, LOG)
    both = both.select("label", "value__leak", F.round("value__ok", 9).alias("honest"))
    return rounded(ev.leak_gap(written(both, "leak"), "label", "value__leak", "honest"))


def _classified(spark, sf):
    guess = argmax(F.col("embedding"))
    return table(spark, sf, "embeddings").select("vec_id", "label", guess.alias("predicted"))


CLASSIFIED = """
  WITH e AS (SELECT label, list_position(embedding, list_max(embedding)) - 1 AS predicted FROM embeddings),
       k AS (SELECT label AS class FROM e UNION SELECT predicted FROM e),
       m AS (SELECT class, (SELECT count(*) FROM e WHERE label = class AND predicted = class) AS tp,
                    (SELECT count(*) FROM e WHERE label <> class AND predicted = class) AS fp,
                    (SELECT count(*) FROM e WHERE label = class AND predicted <> class) AS fn FROM k)
"""


@query(
    "macro_f1",
    CLASSIFIED
    + """
    SELECT round(sum(tp)::DOUBLE / (SELECT count(*) FROM e), 6) AS accuracy,
           round(avg(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0)), 6) AS macro_f1 FROM m
    """,
)
def macro_f1(spark, sf):
    return rounded(ev.macro_f1(_classified(spark, sf), "label", "predicted"))


@query(
    "class_report",
    CLASSIFIED
    + """
    SELECT CAST(class AS INTEGER) AS class, tp, fp, fn,
           round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
           round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
           round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
    FROM m
    """,
)
def class_report(spark, sf):
    return rounded(ev.class_counts(_classified(spark, sf), "label", "predicted"))


@query(
    "confusion_matrix",
    "WITH e AS (SELECT label, list_position(embedding, list_max(embedding)) - 1 AS predicted "
    "FROM embeddings) SELECT label AS actual, "
    + ", ".join(f"count(*) FILTER (WHERE predicted = {k}) AS pred_{k}" for k in range(10))
    + " FROM e GROUP BY label",
)
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(_classified(spark, sf), "label", "predicted", range(10))


def _priced(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    return joined.select(
        (F.col("l_extendedprice") / 1000.0).alias("actual"),
        (F.col("l_quantity") * F.col("p_retailprice") / 1000.0).alias("predicted"),
    )


PRICED = """
  SELECT l_extendedprice / 1000.0::DOUBLE AS actual, l_quantity * p_retailprice / 1000.0::DOUBLE AS predicted
  FROM lineitem JOIN part ON l_partkey = p_partkey
"""


@query(
    "regression_metrics",
    f"""
    SELECT round(sqrt(avg((actual - predicted) ** 2)), 6) AS rmse, round(avg(abs(actual - predicted)), 6) AS mae,
           round(avg((actual - predicted) ** 2), 6) AS mse FROM ({PRICED})
    """,
)
def regression_metrics(spark, sf):
    return rounded(ev.regression_metrics(_priced(spark, sf), "actual", "predicted"))


@query(
    "quality_gate",
    f"""
    {S} {CURVE}, k AS (SELECT {CONFUSION} FROM p), f AS (SELECT {RATES} FROM k),
    r AS (SELECT round(sqrt(avg((actual - predicted) ** 2)), 6) AS rmse FROM ({PRICED}))
    SELECT 'f1' AS metric, (SELECT f1 FROM f) AS value, 0.7::DOUBLE AS threshold, 'maximize' AS direction,
           (SELECT f1 FROM f) >= 0.7 AS passed
    UNION ALL SELECT 'roc_auc', (SELECT {AUC} FROM c), 0.6, 'maximize', (SELECT {AUC} FROM c) >= 0.6
    UNION ALL SELECT 'rmse', rmse, 2.0, 'minimize', rmse <= 2.0 FROM r
    UNION ALL SELECT 'absent', 'NaN'::DOUBLE, 0.5, 'maximize', false
    """,
)
def quality_gate(spark, sf):
    """The default, light and forecast gates, and one whose metric is missing."""
    found = ev.metrics_long(ev.classification_report(scored(spark, sf), "label", "score"))
    errors = ev.metrics_long(ev.regression_metrics(_priced(spark, sf), "actual", "predicted"))
    gates = [ev.quality_gate(found), ev.quality_gate(found, *ev.LIGHT_GATE), ev.quality_gate(errors, *ev.FORECAST_GATE)]
    result = ev.quality_gate(found, "absent", 0.5)
    for g in gates:
        result = result.unionByName(g)
    return rounded(result)


@query(
    "calibration_bins",
    f"""
    {S} SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n,
           round(avg(score), 6) AS mean_score, round(avg(label), 6) AS observed_rate FROM s GROUP BY bin
    """,
)
def calibration_bins(spark, sf):
    return rounded(ev.calibration_bins(scored(spark, sf), "label", "score"))


@query(
    "report_sink",
    f"""
    {S}, k AS (SELECT {CONFUSION} FROM p), f AS (SELECT {RATES} FROM k)
    SELECT 'f1' AS metric, f1 AS value FROM f UNION ALL SELECT 'precision', precision FROM f
    UNION ALL SELECT 'recall', recall FROM f UNION ALL SELECT 'gate_passed', CAST(f1 >= 0.7 AS DOUBLE) FROM f
    """,
)
def report_sink(spark, sf):
    """The report as it is written for others, read back."""
    found = ev.metrics_long(ev.classification_report(scored(spark, sf), "label", "score"))
    path = fresh_path(spark, "report")
    ev.write_report(found, ev.quality_gate(found), path)
    rows = spark.read.text(path).select(F.explode(F.from_json("value", "map<string,double>")).alias("metric", "value"))
    return rounded(rows.where(F.col("metric").isin("f1", "precision", "recall", "gate_passed")))
