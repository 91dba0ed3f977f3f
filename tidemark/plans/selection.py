"""The k-th row of every group by counting: no group is sorted, however many rows it has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.joins import join_small
from tidemark.plans.ordered import rows_per_task
from tidemark.plans.scratch import written

BUCKETS = 4096
GROUP = "__group"


def grouped_cuts(keys: DataFrame, group: Sequence[str], order: Sequence[str], wanted: DataFrame) -> DataFrame:
    """(__group, __cut): the row at position ``k`` of every group, as a struct of the order columns.

    ``wanted`` has (__group, k), groups being structs of the ``group`` columns, so that null is a group like any other;
    groups with k below 1 or beyond their rows are left out. Groups with more rows than one task should sort are narrowed
    down: their rows are counted in BUCKETS equal ranges of the first order column, only the range that holds the k-th row
    stays, and so on, for ties in the next order column. What remains, one task's worth of a group at most, is sorted.
    Order columns that are not numbers are not narrowed. Only counts and the last remaining rows are shuffled.
    """
    order = list(order)
    keys = keys.select(F.struct(*group).alias(GROUP), *order)
    limit = rows_per_task(keys.sparkSession)
    numeric = [c for c in order if isinstance(keys.schema[c].dataType, T.NumericType)]
    spans = [f(c).cast("double").alias(f"__{e}_{c}") for c in numeric for f, e in ((F.min, "lo"), (F.max, "hi"))]
    sizes = keys.groupBy(GROUP).agg(F.count(F.lit(1)).alias("__n"), *spans)
    state = join_small(wanted, sizes, [GROUP], "inner").where("k >= 1 and k <= __n")
    whole = {"__base": F.lit(0).cast("long"), **{f"__nulls_{c}": F.lit(True) for c in numeric}}
    state = written(state.withColumns(whole), "selection")

    def inside(rows: DataFrame) -> DataFrame:
        met = join_small(rows, state, [GROUP], "inner")
        for c in numeric:
            between = F.col(c).cast("double").between(F.col(f"__lo_{c}"), F.col(f"__hi_{c}"))
            met = met.where(F.when(F.col(c).isNull(), F.col(f"__nulls_{c}")).otherwise(F.coalesce(between, F.lit(False))))
        return met

    most = state.agg(F.max("__n")).first()[0] or 0
    for column in numeric if most > limit else []:
        lo, hi = F.col(f"__lo_{column}"), F.col(f"__hi_{column}")
        wide = (F.col("__n") > limit) & (lo < hi)
        while not state.where(wide).isEmpty():
            met = inside(keys).where(wide)
            place = F.floor((F.col(column).cast("double") - lo) / (hi - lo) * BUCKETS)
            place = F.when(F.col(column).isNull(), -1).otherwise(F.least(place, F.lit(BUCKETS - 1)))
            counts = met.groupBy(GROUP, place.alias("__place")).agg(
                F.count(F.lit(1)).alias("__in"), F.min(column).cast("double").alias("__min"), F.max(column).cast("double").alias("__max"),
                F.first("k").alias("__k"), F.first("__base").alias("__before"))
            upto = F.sum("__in").over(Window.partitionBy(GROUP).orderBy("__place")) + F.col("__before")
            counts = counts.withColumn("__upto", upto)
            found = counts.where((F.col("__upto") >= F.col("__k")) & (F.col("__upto") - F.col("__in") < F.col("__k")))
            found = found.select(GROUP, "__in", "__min", "__max", (F.col("__upto") - F.col("__in")).alias("__start"))
            state = join_small(state, found, [GROUP])
            here = F.col("__in").isNotNull()
            state = state.withColumns({
                "__n": F.when(here, F.col("__in")).otherwise(F.col("__n")),
                "__base": F.when(here, F.col("__start")).otherwise(F.col("__base")),
                f"__lo_{column}": F.when(here, F.col("__min")).otherwise(lo),
                f"__hi_{column}": F.when(here, F.col("__max")).otherwise(hi),
                f"__nulls_{column}": F.when(here, F.col("__min").isNull()).otherwise(F.col(f"__nulls_{column}")),
            }).drop("__in", "__min", "__max", "__start")
            state = written(state, "selection")
    nth = F.row_number().over(Window.partitionBy(GROUP).orderBy(*order)) + F.col("__base")
    placed = inside(keys).withColumn("__nth", nth).where(F.col("__nth") == F.col("k"))
    return placed.select(GROUP, F.struct(*order).alias("__cut"))


def upto_cuts(df: DataFrame, group: Sequence[str], order: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``df`` with ``__chosen``: whether a row stands at or before the cut of its group. The table is not shuffled."""
    marked = join_small(df.withColumn(GROUP, F.struct(*group)), cuts, [GROUP])
    chosen = F.coalesce(F.struct(*order) <= F.col("__cut"), F.lit(False))
    return marked.withColumn("__chosen", chosen).drop(GROUP, "__cut")
