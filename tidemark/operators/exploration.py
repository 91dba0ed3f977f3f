"""Exploratory aggregates: (df, columns, by) in, small tables out."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.functions.exprs import equal_width_bin
from tidemark.plans.distribution import moments_of_counts, quantiles_of_counts, value_counts_of
from tidemark.plans.joins import join_small


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std, min, quartiles (interpolated) and max per column, with its type."""
    counts = value_counts_of(df, columns, by)
    moments = moments_of_counts(counts, by)
    quartiles = quantiles_of_counts(counts, [0.25, 0.5, 0.75], by).drop("n")
    named = quartiles.withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"})
    types = F.create_map(*[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())])
    return moments.join(named, [*by, "feature"]).withColumn("dtype", types[F.col("feature")])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def entity_summary(df: DataFrame, columns: Sequence[str], label: str, entity: Sequence[str]) -> DataFrame:
    """Per entity: rows, label rate and mean readings."""
    means = [F.avg(c).alias(f"mean_{c}") for c in columns]
    return df.groupBy(*entity).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("label_rate"), *means)


def means_by(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs from one pass, as (x, y, correlation) rows."""
    above = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in above])

    def value(a: str, b: str):
        if a == b:
            return F.lit(1.0)
        return F.col(f"`{a}|{b}`") if (a, b) in above else F.col(f"`{b}|{a}`")

    lines = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), value(a, b).alias("correlation"))
        for a, b in product(columns, columns)
    ]
    return wide.select(F.inline(F.array(*lines)))


def class_histogram(df: DataFrame, column: str, by: str, bins: int = 15) -> DataFrame:
    """Histogram per class; each class has its own range, as when plotted one by one."""
    ranges = df.groupBy(by).agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
    placed = join_small(df.select(by, column), ranges, [by], "inner")
    place = equal_width_bin(F.col(column), F.col("__low"), F.col("__high"), bins)
    return placed.where(F.col(column).isNotNull()).groupBy(by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def split_label_counts(df: DataFrame, split: str, label: str) -> DataFrame:
    """Counts per split and label, with totals shown as ``*``."""
    cubed = df.cube(split, label).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(split).alias("__s"), F.grouping(label).alias("__l")
    )
    named = {c: F.when(F.col(g) == 1, "*").otherwise(F.col(c).cast("string")) for c, g in ((split, "__s"), (label, "__l"))}
    return cubed.withColumns(named).drop("__s", "__l")


def extent(df: DataFrame, contract: Contract = Contract(), approximate: bool = False) -> DataFrame:
    """Rows, distinct entities and first and last time."""
    entity = F.struct(*contract.entity)
    distinct = F.approx_count_distinct(entity) if approximate else F.count_distinct(*[F.col(e) for e in contract.entity])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct.alias("n_entities"),
        F.min(contract.time).alias("first_ts"),
        F.max(contract.time).alias("last_ts"),
    )
