"""Columns as mergeable summaries: exact moments and quantile sketches that add up over tasks, days and tables.

A sketch (KLL) holds about three times ``k`` values whatever the column. Ranks from it are off by at most
`rank_error(k)` of the rows, at 99 % confidence, and exact while a column has at most ``k`` values. No value of a column
is sorted, grouped or shuffled: a task sends one sketch per group and column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ks_p_value
from tidemark.operators.drift import P_THRESHOLD

K = 4096
MEASURES = ("n", "mean", "m2", "min", "max", "sketch")


def rank_error(k: int = K) -> float:
    """Share of the rows by which a rank from one sketch may be off; merging does not add to it."""
    return 2.296 / k**0.9723


def summaries(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """(by..., feature, n, mean, m2, min, max, sketch) of number columns, from one pass. Missing values and NaN are
    left out; a column without values has n 0 and nulls."""
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"__{i}") for i, c in enumerate(columns)]
    rows = df.select(*by, *numbers)
    made = []
    for i in range(len(columns)):
        x = F.col(f"__{i}")
        made += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"m2{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"sketch{i}"),
        ]
    wide = rows.groupBy(*by).agg(*made)
    lines = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}{i}").alias(m) for m in MEASURES]) for i, c in enumerate(columns)
    ]
    return wide.select(*by, F.inline(F.array(*lines)))


def merged(parts: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The summaries of groups from the summaries of their parts: days to weeks, tables to a whole."""
    some = parts.where("n > 0")
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
    return some.groupBy(*by, "feature").agg(
        n.alias("n"), mean.alias("mean"), (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile(p: float, sketch: str = "sketch") -> Column:
    """The least value that at least a share ``p`` of the rows does not exceed."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))


def points(n: int, sketch: str = "sketch") -> Column:
    """The quantiles at 1 / n, 2 / n, ..., 1, ascending."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / n) for i in range(1, n + 1)]))


def share_upto(value: Column, at: Column) -> Column:
    """The share of rows that do not exceed the value, from their `points`."""
    return F.size(F.filter(at, lambda q: q <= value)) / F.size(at)


def described(found: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(..., feature, count, mean, std, min, p25, ..., max) of summaries."""
    by = [c for c in found.columns if c not in (*MEASURES, "feature")]
    std = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
    known = F.col("n") > 0
    quantiles = [F.when(known, quantile(p)).alias(f"p{p * 100:g}") for p in probabilities]
    return found.select(
        *by, "feature", F.col("n").alias("count"), "mean", std.alias("std"), "min", *quantiles, "max")


def profile(df: DataFrame, columns: Sequence[str], version: str, k: int = K) -> DataFrame:
    """The summaries of a reference table tied to a model version, to be kept in place of the table."""
    return summaries(df, columns, k=k).select(F.lit(version).alias("version"), "feature", *MEASURES)


def drift_of_summaries(
    reference: DataFrame,
    current: DataFrame,
    by: Sequence[str] = (),
    bins: int = 10,
    resolution: int = 1000,
    floor: float = 1e-4,
    alpha: float = P_THRESHOLD,
) -> DataFrame:
    """K-S distance, PSI, p-value and flag per column from two tables of summaries; no data is read.

    Both sides are read off at ``resolution`` quantiles, so a share of rows is off by at most `rank_error` and
    1 / resolution, a share between two values by twice that. PSI bins end at the reference's quantiles at 1 / bins,
    2 / bins, ...; the K-S distance is the largest difference of shares at any of the quantiles. Columns without values
    on a side have no row.
    """
    by = list(by)
    left = reference.where("n > 0").select(*by, "feature", F.col("n").alias("n_ref"), points(resolution).alias("__ref"))
    right = current.where("n > 0").select(*by, "feature", F.col("n").alias("n_cur"), points(resolution).alias("__cur"))
    both = left.join(right, [*by, "feature"])
    r, c = F.col("__ref"), F.col("__cur")
    gaps = F.transform(F.array_union(r, c), lambda x: F.abs(share_upto(x, r) - share_upto(x, c)))
    edges = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), lambda i: F.get(r, F.ceil(i * resolution / bins).cast("int") - 1)))
    both = both.withColumns({"__gap": F.array_max(gaps), "__edges": edges})

    def widths(side: Column) -> Column:
        upto = F.transform("__edges", lambda x: share_upto(x, side))
        return F.zip_with(
            F.concat(upto, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), upto), lambda a, b: F.greatest(a - b, F.lit(floor)))

    terms = F.zip_with(widths(r), widths(c), lambda a, b: (b - a) * F.ln(b / a))
    found = both.select(
        *by, "feature", "n_ref", "n_cur", F.col("__gap").alias("statistic"),
        F.aggregate(terms, F.lit(0.0), lambda a, x: a + x).alias("psi"))
    tested = found.withColumn("p_value", ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur")))
    return tested.withColumn("drifted", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
