"""Distribution frames: distinct values with counts and running counts, and exact quantiles from them.

Every distance and quantile here starts from one aggregate to distinct values, which combines before
the shuffle, so a value that fills a third of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.joins import join_small
from tidemark.plans.ordered import running, with_window
from tidemark.plans.scratch import written


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) with missing values and NaN left out."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(keep), list(columns), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts_of(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct values of each column with their count ``n``, written once: the only read of the table."""
    counts = long_values(df, columns, by).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return written(counts, "counts")


def two_sided(
    df: DataFrame, columns: Sequence[str], is_reference: Column, by: Sequence[str] = (), following: bool = False
) -> DataFrame:
    """Distinct values of each column with their counts on both sides.

    Columns: by..., feature, value, ref, cur, cum_ref, cum_cur (counts up to the value), n_ref, n_cur. The table is read
    once, for counts that are written; sizes, cuts and running counts come from those.
    """
    long = long_values(df.withColumn("__ref", is_reference), columns, [*by, "__ref"])
    return with_running(written(count_sides(long, by), "sides"), by, following)


def count_sides(long: DataFrame, by: Sequence[str]) -> DataFrame:
    counts = long.groupBy(*by, "feature", "value").agg(
        F.count_if(F.col("__ref")).alias("ref"), F.count(F.lit(1)).alias("__n")
    )
    return counts.select(*by, "feature", "value", "ref", (F.col("__n") - F.col("ref")).alias("cur"))


def with_running(counts: DataFrame, by: Sequence[str], following: bool = False) -> DataFrame:
    """Add running counts and side totals to distinct values with ``ref`` and ``cur`` counts, a written table.

    With ``following`` also the next value of the group, as ``__next``.
    """
    groups = [*by, "feature"]
    sums = {"cum_ref": ("sum", F.col("ref")), "cum_cur": ("sum", F.col("cur"))}
    totals = {"n_ref": F.col("ref"), "n_cur": F.col("cur")}
    rows = counts
    if following:
        rows = with_window(counts, groups, ["value"], lambda w: {"__next": F.lead("value").over(w)}, after=1)
    raw = {**{n: e for n, (_, e) in sums.items()}, **totals}
    return running(rows, groups, ["value"], sums, totals, counts, raw=raw)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles, one row per (by, feature) with columns q0, q1, ...

    Found from running counts over distinct values, so no task holds a whole column.
    """
    return quantiles_of_counts(value_counts_of(df, columns, by), probabilities, by)


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """`exact_quantiles` from the counts of `value_counts_of`."""
    groups = [*by, "feature"]
    placed = running(counts, groups, ["value"], {"upto": ("sum", F.col("n"))}, {"total": F.col("n")})
    picks = [F.first("total").alias("n")]
    for i, p in enumerate(probabilities):
        spot = (F.col("total") - 1) * F.lit(float(p))
        picks.append(F.min(F.when(F.col("upto") > F.floor(spot), F.col("value"))).alias(f"__lo{i}"))
        picks.append(F.min(F.when(F.col("upto") > F.ceil(spot), F.col("value"))).alias(f"__hi{i}"))
    found = placed.groupBy(*groups).agg(*picks)
    values = []
    for i, p in enumerate(probabilities):
        spot = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        values.append((low + (spot - F.floor(spot)) * (high - low)).alias(f"q{i}"))
    return found.select(*groups, "n", *values)


def moments_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, least and greatest value per (by, feature) from counts of distinct values.

    Squares are taken around the mean, in a second step over the counts, so large values do not cancel.
    """
    groups = [*by, "feature"]
    weigh = lambda e: F.sum(e * F.col("n"))
    first = counts.groupBy(*groups).agg(
        F.sum("n").alias("count"), (weigh(F.col("value")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    around = join_small(counts, first, groups, how="inner").groupBy(*groups, "count", "mean", "min", "max")
    squares = around.agg(weigh(F.pow(F.col("value") - F.col("mean"), 2)).alias("__squares"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("__squares") / (F.col("count") - 1)))
    return squares.select(*groups, "count", "mean", std.alias("std"), "min", "max")
