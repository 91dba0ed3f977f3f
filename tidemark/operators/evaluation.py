"""Evaluation metrics, curves and the quality gate, all from small aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio
from tidemark.plans.ordered import running

# Metrics where smaller is better, and the default gates.
MINIMIZE = ("rmse", "mae", "mse")
DEFAULT_GATE = ("f1", 0.70)
FORECAST_GATE = ("rmse", 2.0)
LIGHT_GATE = ("roc_auc", 0.6)
_NEG = "__minus_score"


def threshold_flag(df: DataFrame, score: str, threshold: float = 0.5, name: str = "predicted") -> DataFrame:
    """1 when the score reaches the threshold (inclusive)."""
    return df.withColumn(name, (F.col(score) >= F.lit(threshold)).cast("int"))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def _confusion(label: str, predicted: str) -> list[Column]:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return [
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    ]


def binary_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and accuracy, precision, recall, F1 (0 where undefined), in one pass."""
    counts = df.groupBy(*by).agg(*_confusion(label, predicted))
    return counts.withColumns(_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def slice_metrics(df: DataFrame, label: str, predicted: str, slices: Sequence[str]) -> DataFrame:
    """The same metrics for every combination of slices, every single slice, and the total.

    A slice column that is summed over shows ``*``.
    """
    level = [F.grouping(s).alias(f"__all_{s}") for s in slices]
    counts = df.cube(*slices).agg(*_confusion(label, predicted), *level)
    names = {s: F.when(F.col(f"__all_{s}") == 1, "*").otherwise(F.col(s).cast("string")) for s in slices}
    rated = counts.withColumns({**names, **_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])})
    return rated.drop(*[f"__all_{s}" for s in slices])


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: positives, negatives, both counted from the highest score, and totals."""
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    rows = rows.select(*by, (-F.col(score)).alias(_NEG), F.col(label).alias("__y"))
    hits = (F.col("__y") == 1).cast("long")
    counts = rows.groupBy(*by, _NEG).agg(F.sum(hits).alias("pos"), F.sum(1 - hits).alias("neg"))
    sums = {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}
    totals = {"n_pos": F.col("pos"), "n_neg": F.col("neg")}
    raw = {"tp": hits, "fp": 1 - hits, "n_pos": hits, "n_neg": 1 - hits}
    curve = running(counts, by, [_NEG], sums, totals, sizing=rows, raw=raw)
    return curve.withColumn(score, -F.col(_NEG)).drop(_NEG)


def _areas() -> list[Column]:
    """ROC-AUC (ties count half) and average precision; NULL unless both classes occur."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    both = (F.sum("pos") > 0) & (F.sum("neg") > 0)
    auc = F.sum(neg * (tp - pos / 2.0)) / (F.sum(pos) * F.sum(neg))
    ap = F.sum(pos * tp / (tp + fp)) / F.sum(pos)
    return [F.when(both, auc).alias("roc_auc"), F.when(both, ap).alias("aucpr")]


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return score_curve(df, label, score, by).groupBy(*by).agg(*_areas())


def classification_report(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """All classification metrics of a scored table from one grouped curve."""
    hit = F.col(score) >= F.lit(threshold)
    counted = [
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("__tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("__fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("__fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("__tn"),
    ]
    summed = score_curve(df, label, score, by).groupBy(*by).agg(*counted, *_areas())
    rates = _rates(*[F.col(c) for c in ("__tp", "__fp", "__fn", "__tn")])
    return summed.withColumns(rates).select(*by, *rates, "roc_auc", "aucpr")


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct threshold."""
    return score_curve(df, label, score).select(
        F.col(score).alias("threshold"),
        ratio(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )


def leak_gap(df: DataFrame, label: str, leaky: str, honest: str) -> DataFrame:
    """AUC of a leaky score, of the honest one, and by how much the leak inflates it."""
    both = df.select(
        F.col(label).alias("__label"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.col(c).alias("s")) for n, c in
                            (("leaky", leaky), ("honest", honest))])).alias("__x"),
    ).select("__label", "__x.side", "__x.s")
    areas = ranking_metrics(both, "__label", "s", ["side"])
    wide = areas.agg(*[F.max(F.when(F.col("side") == s, F.col("roc_auc"))).alias(f"auc_{s}") for s in ("leaky", "honest")])
    gap = F.col("auc_leaky") - F.col("auc_honest")
    return wide.withColumns({"gap": gap, "relative_gap": F.try_divide(gap, F.col("auc_honest"))})


def class_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class: true positives, false positives, false negatives, precision, recall, F1."""
    pairs = df.groupBy(F.col(label).alias("y"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    same, n, zero = F.col("y").eqNullSafe(F.col("p")), F.col("n"), F.lit(0).cast("long")
    lines = F.array(
        F.struct(
            F.col("y").alias("class"),
            F.when(same, n).otherwise(zero).alias("tp"),
            zero.alias("fp"),
            F.when(same, zero).otherwise(n).alias("fn"),
        ),
        F.struct(
            F.col("p").alias("class"), zero.alias("tp"), F.when(same, zero).otherwise(n).alias("fp"), zero.alias("fn")
        ),
    )
    counts = pairs.select(F.inline(lines)).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}
    )


def macro_f1(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy and unweighted mean F1 over the classes seen in labels or predictions."""
    per_class = class_counts(df, label, predicted)
    return per_class.agg(
        ratio(F.sum("tp"), F.sum(F.col("tp") + F.col("fn"))).alias("accuracy"), F.avg("f1").alias("macro_f1")
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: Sequence) -> DataFrame:
    """Counts with one row per true class and one column per predicted class."""
    wide = df.groupBy(label).pivot(predicted, list(classes)).agg(F.count(F.lit(1)))
    named = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"pred_{c}") for c in classes]
    return wide.select(F.col(label).alias("actual"), *named)


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and MSE. Array columns (a forecast horizon) are flattened first."""
    if df.schema[actual].dataType.typeName() == "array":
        pairs = F.explode(F.arrays_zip(F.col(actual).alias("a"), F.col(predicted).alias("p"))).alias("__z")
        df = df.select(*by, pairs).select(*by, F.col("__z.a").alias(actual), F.col("__z.p").alias(predicted))
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse")
    )


def metrics_long(wide: DataFrame) -> DataFrame:
    """A one-row metrics table as (metric, value) rows."""
    return wide.select([F.col(c).cast("double").alias(c) for c in wide.columns]).unpivot(
        [], wide.columns, "metric", "value"
    )


def quality_gate(metrics: DataFrame, metric: str = DEFAULT_GATE[0], threshold: float = DEFAULT_GATE[1]) -> DataFrame:
    """One row: did the metric reach its threshold? A missing or NaN metric never passes."""
    smaller = metric in MINIMIZE
    value = F.nanvl(F.max(F.when(F.col("metric") == metric, F.col("value"))), F.lit(None).cast("double"))
    x = F.col("value")
    passed = x <= threshold if smaller else x >= threshold
    return metrics.agg(value.alias("value")).select(
        F.lit(metric).alias("metric"),
        F.coalesce(x, F.lit(float("nan"))).alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit("minimize" if smaller else "maximize").alias("direction"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def calibration_bins(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and observed rate per equal-width score bin; rows without a score or label are in none."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int").alias("bin")
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    return known.groupBy(place).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("observed_rate")
    )


def write_report(metrics: DataFrame, gate: DataFrame, path: str) -> None:
    """Write the metrics and the gate flag (1.0 or 0.0) as one JSON object. Both inputs are tiny."""
    flag = gate.select(F.lit("gate_passed").alias("metric"), F.col("passed").cast("double").alias("value"))
    entries = metrics.select("metric", "value").unionByName(flag)
    report = entries.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    report.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite").text(path)
