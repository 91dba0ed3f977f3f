"""Drift between a reference and a current side: distances, alerts, profiles, decisions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import LABEL, Contract
from tidemark.functions.exprs import chi_square_p_value, equal_width_bin, ks_p_value, ratio, two_proportion_z
from tidemark.functions.times import truncated
from tidemark.plans.distribution import (
    count_sides,
    long_values,
    moments_of_counts,
    quantiles_of_counts,
    two_sided,
    value_counts_of,
    with_running,
)
from tidemark.plans.scratch import written

# Significance level, share of columns that makes a dataset drift, current window,
# sweep of shifts in reference standard deviations, histogram bins.
P_THRESHOLD = 0.05
DRIFT_SHARE = 0.5
CURRENT_WINDOW = timedelta(hours=24)
SWEEP = (0.0, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
OVERLAY_BINS = 25


def monitored_columns(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, contract: Contract = Contract(),
    label: str | None = LABEL, numeric: bool | None = None,
) -> list[str]:
    """The given columns, or those both sides share, without keys, time and label.

    With ``numeric`` only number columns (for distances such as K-S), or only the others (for `category_drift`).
    """
    if columns is None:
        skip = {*contract.key, *contract.tie, label}
        columns = [c for c in reference.columns if c in current.columns and c not in skip]
    if numeric is not None:
        is_number = lambda c: isinstance(reference.schema[c].dataType, T.NumericType)
        columns = [c for c in columns if is_number(c) == numeric]
    if not columns:
        raise ValueError("reference and current share no columns to compare")
    return list(columns)


def stack_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two tables as one with a ``side`` column."""
    sides = [(reference, "reference"), (current, "current")]
    parts = [d.select(*columns).withColumn("side", F.lit(name)) for d, name in sides]
    return parts[0].unionByName(parts[1])


def _is_reference() -> Column:
    return F.col("side") == "reference"


def _ks_from(frame: DataFrame, by: Sequence[str], alpha: float) -> DataFrame:
    found = frame.groupBy(*by, "feature").agg(
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"), F.max(_gap()).alias("statistic")
    )
    p = ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur"))
    tested = found.withColumn("p_value", F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), p))
    return tested.withColumn("drifted", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def ks_drift(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), alpha: float = P_THRESHOLD) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance, asymptotic p-value and flag per column.

    ``df`` has a ``side`` column. With ``by`` (hour of day, weekday) every season is compared with
    its own reference.
    """
    return _ks_from(two_sided(df, columns, _is_reference(), by), by, alpha)


def dataset_drift(per_column: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """Roll-up: the dataset drifts when more than ``share`` of its columns do."""
    rolled = per_column.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted"))
    rolled = rolled.withColumn("share_drifted", ratio(F.col("n_drifted"), F.col("n_columns")))
    return rolled.withColumn("dataset_drift", F.col("share_drifted") > share)


def inject_drift(df: DataFrame, column: str, shift: float | Column = 0.0, scale: float = 1.0) -> DataFrame:
    """The column scaled, then shifted: an artificial covariate drift."""
    return df.withColumn(column, F.col(column) * F.lit(scale) + (shift if isinstance(shift, Column) else F.lit(shift)))


def current_window(df: DataFrame, window: timedelta = CURRENT_WINDOW, contract: Contract = Contract()) -> DataFrame:
    """Rows of the last ``window`` before the newest row.

    The newest time is fetched first, so that the filter is a constant the file scan can prune by.
    """
    newest = df.agg(F.max(contract.time)).first()[0]
    if newest is None:
        return df.where(F.lit(False))
    edge = F.lit(newest - window).cast(df.schema[contract.time].dataType)
    return df.where(F.col(contract.time) > edge)


def psi(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index over bins that split the reference evenly.

    A value's bin follows from the share of reference rows below it. Empty shares count as ``floor``.
    """
    frame = two_sided(df, columns, _is_reference(), by)
    below = ratio((F.col("cum_ref") - F.col("ref")) * bins, F.col("n_ref"))
    place = F.least(F.floor(below), F.lit(bins - 1)).cast("int")
    binned = frame.groupBy(*by, "feature", place.alias("bin")).agg(
        F.greatest(ratio(F.sum("ref"), F.first("n_ref")), F.lit(floor)).alias("r"),
        F.greatest(ratio(F.sum("cur"), F.first("n_cur")), F.lit(floor)).alias("c"),
    )
    term = (F.col("c") - F.col("r")) * F.ln(F.col("c") / F.col("r"))
    return binned.groupBy(*by, "feature").agg(F.sum(term).alias("psi"))


def _gap() -> Column:
    return F.abs(ratio(F.col("cum_ref"), F.col("n_ref")) - ratio(F.col("cum_cur"), F.col("n_cur")))


def wasserstein(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """First Wasserstein distance: area between the two distribution functions."""
    frame = two_sided(df, columns, _is_reference(), by, following=True)
    area = F.coalesce(F.sum(_gap() * (F.col("__next") - F.col("value"))), F.lit(0.0))
    return frame.groupBy(*by, "feature").agg(area.alias("wasserstein"))


def _report_from(
    frame: DataFrame, by: Sequence[str], alpha: float, bins: int = 10, floor: float = 1e-4
) -> DataFrame:
    """All distances from one frame: first per bin of the reference, then per column."""
    groups = [*by, "feature"]
    below = ratio((F.col("cum_ref") - F.col("ref")) * bins, F.col("n_ref"))
    place = F.least(F.floor(below), F.lit(bins - 1)).cast("int")
    binned = frame.groupBy(*groups, place.alias("__bin")).agg(
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"), F.max(_gap()).alias("__gap"),
        F.sum(_gap() * (F.col("__next") - F.col("value"))).alias("__area"),
        F.greatest(ratio(F.sum("ref"), F.first("n_ref")), F.lit(floor)).alias("__r"),
        F.greatest(ratio(F.sum("cur"), F.first("n_cur")), F.lit(floor)).alias("__c"),
    )
    term = (F.col("__c") - F.col("__r")) * F.ln(F.col("__c") / F.col("__r"))
    found = binned.groupBy(*groups).agg(
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"), F.max("__gap").alias("statistic"),
        F.sum(term).alias("psi"), F.coalesce(F.sum("__area"), F.lit(0.0)).alias("wasserstein"),
    )
    p = F.when(
        (F.col("n_ref") > 0) & (F.col("n_cur") > 0), ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur"))
    )
    tested = found.withColumn("p_value", p)
    return tested.withColumn("drifted", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def drift_report(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), alpha: float = P_THRESHOLD, bins: int = 10
) -> DataFrame:
    """K-S, PSI and Wasserstein distance of every number column, with p-value and flag, from one read of the table.

    Missing values and NaN are left out. A column without a value on one side has no p-value and does not drift; one
    without any value has no row.
    """
    return _report_from(two_sided(df, columns, _is_reference(), by, following=True), by, alpha, bins)


def reference_counts(df: DataFrame, columns: Sequence[str], version: str) -> DataFrame:
    """A reference table as counts of distinct values, tied to a version: (version, feature, value, n)."""
    return value_counts_of(df, columns).select(F.lit(version).alias("version"), "feature", "value", "n")


def counts_against(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of both sides, from stored `reference_counts` of one version and one read of the current table."""
    none = F.lit(0).cast("long")
    known = reference.where(F.col("feature").isin(list(columns)))
    rows = known.select("feature", "value", F.col("n").alias("ref"), none.alias("cur")).unionByName(
        long_values(current, columns).select("feature", "value", none.alias("ref"), none.alias("cur") + 1)
        .toDF("feature", "value", "ref", "cur")
    )
    merged = rows.groupBy("feature", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    return written(merged, "sides")


def drift_from_profile(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = P_THRESHOLD, bins: int = 10
) -> DataFrame:
    """`drift_report` of a current table against stored `reference_counts`; the reference table is not read."""
    return _report_from(with_running(counts_against(reference, current, columns), [], following=True), [], alpha, bins)


def drift_sweep(df: DataFrame, column: str, steps: Sequence[float] = SWEEP, alpha: float = P_THRESHOLD) -> DataFrame:
    """K-S test of the current side shifted by each step times the reference standard deviation.

    The table is first reduced to distinct values with counts; only those are repeated per step.
    """
    long = long_values(df.withColumn("__ref", _is_reference()), [column], ["__ref"])
    counts = written(count_sides(long, []), "sides")
    spread = moments_of_counts(counts.where("ref > 0").select("feature", "value", F.col("ref").alias("n"))).first()
    sigma = F.lit(spread["std"] if spread else None).cast("double")
    shifted = counts.select("*", F.explode(F.array(*[F.lit(float(k)) for k in steps])).alias("shift_sd"))
    # the reference copy of a value stays, the current copy moves
    halves = F.array(
        F.struct(F.col("value").alias("value"), F.col("ref").alias("ref"), F.lit(0).cast("long").alias("cur")),
        F.struct(
            (F.col("value") + F.col("shift_sd") * sigma).alias("value"),
            F.lit(0).cast("long").alias("ref"),
            F.col("cur").alias("cur"),
        ),
    )
    moved = shifted.select("shift_sd", "feature", F.inline(halves)).groupBy("shift_sd", "feature", "value")
    merged = moved.agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    return _ks_from(with_running(written(merged, "moved"), ["shift_sd"]), ["shift_sd"], alpha)


def overlay_histogram(df: DataFrame, columns: Sequence[str], bins: int = OVERLAY_BINS) -> DataFrame:
    """Histogram density of both sides on shared bin edges."""
    long = long_values(df, columns, ["side"])
    edges = long.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    placed = long.join(F.broadcast(edges), "feature")  # one row per column
    counts = placed.groupBy(
        "feature", "side", "low", "high", equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    side = Window.partitionBy("feature", "side")  # at most `bins` rows
    width = (F.col("high") - F.col("low")) / bins
    density = F.try_divide(F.col("n"), F.sum("n").over(side) * width)
    return counts.select("feature", "side", "bin", (F.col("low") + F.col("bin") * width).alias("edge"), "n", density.alias("density"))


def entity_mix(df: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Rows per entity on both sides. Entities on one side only make other drift results suspect."""
    counts = df.groupBy(*entity).agg(
        F.count_if(_is_reference()).alias("n_ref"), F.count_if(~_is_reference()).alias("n_cur")
    )
    return counts.withColumn("in_both", (F.col("n_ref") > 0) & (F.col("n_cur") > 0))


def category_drift(df: DataFrame, column: str, floor: float = 1e-4, alpha: float = P_THRESHOLD) -> DataFrame:
    """Chi-square statistic of side against category, degrees of freedom, PSI of the shares, p-value and flag.

    NULL is a category. With fewer than two categories, or an empty side, there is no p-value and no drift.
    """
    counts = df.groupBy(F.col(column).alias("category")).agg(
        F.count_if(_is_reference()).alias("a"), F.count_if(~_is_reference()).alias("b")
    )
    counts = written(counts, "categories")
    sums = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    all_a, all_b = (F.lit(n or 0).cast("long") for n in sums)
    share_a = F.greatest(ratio(F.col("a"), all_a), F.lit(floor))
    share_b = F.greatest(ratio(F.col("b"), all_b), F.lit(floor))
    expected_a = (F.col("a") + F.col("b")) * ratio(all_a, all_a + all_b)
    expected_b = (F.col("a") + F.col("b")) * ratio(all_b, all_a + all_b)
    part = F.try_divide(F.pow(F.col("a") - expected_a, 2), expected_a) + F.try_divide(
        F.pow(F.col("b") - expected_b, 2), expected_b
    )
    terms = counts.select(part.alias("chi"), ((share_b - share_a) * F.ln(share_b / share_a)).alias("psi"))
    found = terms.agg(
        F.sum("chi").alias("chi_square"), (F.count(F.lit(1)) - 1).alias("dof"), F.sum("psi").alias("psi")
    )
    found = found.withColumn("p_value", chi_square_p_value(F.col("chi_square"), F.col("dof")))
    return found.withColumn("drifted", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def mixed_drift(
    df: DataFrame, numbers: Sequence[str], categories: Sequence[str], alpha: float = P_THRESHOLD
) -> DataFrame:
    """One row per column, whatever its kind: feature, test, statistic, p_value, psi, drifted. `dataset_drift` rolls
    them up."""
    columns = ["feature", "test", "statistic", "p_value", "psi", "drifted"]
    made = []
    if numbers:
        made.append(drift_report(df, numbers, alpha=alpha).withColumn("test", F.lit("ks")).select(*columns))
    for c in categories:
        one = category_drift(df, c, alpha=alpha).withColumnRenamed("chi_square", "statistic")
        made.append(one.withColumns({"feature": F.lit(c), "test": F.lit("chi_square")}).select(*columns))
    if not made:
        raise ValueError("no columns to compare")
    rows = made[0]
    for one in made[1:]:
        rows = rows.unionByName(one)
    return rows


def label_drift(df: DataFrame, label: str, period: str, contract: Contract = Contract()) -> DataFrame:
    """Positive rate per period and its z statistic against the rate of the reference side."""
    base = df.where(_is_reference()).agg(F.count_if(F.col(label) == 1).alias("x"), F.count(label).alias("n"))
    x0, n0 = base.select("x").scalar(), base.select("n").scalar()
    rates = df.groupBy(truncated(df, contract.time, period).alias("period")).agg(
        F.count(label).alias("n"), F.count_if(F.col(label) == 1).alias("n_positive")
    )
    return rates.select(
        "period", "n", "n_positive", ratio(F.col("n_positive"), F.col("n")).alias("rate"),
        two_proportion_z(F.col("n_positive"), F.col("n"), x0, n0).alias("z"),
    )


def consecutive_alert(df: DataFrame, keys: Sequence[str], day: str, flag: str, days: int) -> DataFrame:
    """Runs of flagged days (one row per key and day) that last at least ``days`` days without a gap."""
    window = Window.partitionBy(*keys).orderBy("__day")
    flagged = df.where(F.col(flag)).select(*keys, F.col(day).cast("date").alias("__day"))
    island = F.date_sub("__day", F.row_number().over(window))
    runs = flagged.withColumn("__island", island).groupBy(*keys, "__island")
    found = runs.agg(
        F.min("__day").alias("first_day"), F.max("__day").alias("last_day"), F.count(F.lit(1)).alias("n_days")
    )
    return found.where(F.col("n_days") >= days).drop("__island")


def reference_profile(df: DataFrame, columns: Sequence[str], version: str, bins: int = 10) -> DataFrame:
    """Summary of a reference table tied to a model version: moments and bin edges per column."""
    counts = value_counts_of(df, columns)
    moments = moments_of_counts(counts).select("feature", F.col("count").alias("n"), "mean", "std", "min", "max")
    cuts = quantiles_of_counts(counts, [i / bins for i in range(1, bins)]).drop("n")
    edges = [F.col(f"q{i}").alias(f"edge_{i + 1}") for i in range(bins - 1)]
    return moments.join(cuts, "feature").select(F.lit(version).alias("version"), *moments.columns, *edges)


def retrain_decision(drift: DataFrame, gate: DataFrame, versions: DataFrame) -> DataFrame:
    """One decision row from a dataset drift row, a gate row and (old, new) table fingerprints.

    Retrain when the dataset drifts, the gate fails, or the table changed.
    """
    facts = [
        drift.select(F.lit("dataset_drift").alias("fact"), F.col("dataset_drift").alias("holds")),
        gate.select(F.lit("gate_failed").alias("fact"), (~F.col("passed")).alias("holds")),
        versions.select(F.lit("new_data").alias("fact"), (F.col("old") != F.col("new")).alias("holds")),
    ]
    rows = facts[0].unionByName(facts[1]).unionByName(facts[2])
    names = ("dataset_drift", "gate_failed", "new_data")
    wide = rows.agg(*[F.bool_or(F.when(F.col("fact") == n, F.col("holds"))).alias(n) for n in names])
    any_of = F.col(names[0]) | F.col(names[1]) | F.col(names[2])
    return wide.withColumn("retrain", F.coalesce(any_of, F.lit(False)))
