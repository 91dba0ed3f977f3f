"""Trials that give way early: successive halving, its asynchronous form, and Hyperband, over a log of steps."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import hash_share
from tidemark.plans.scratch import written
from tidemark.plans.selection import GROUP, grouped_cuts, upto_cuts


def rungs(first: int, last: int, eta: int) -> list[int]:
    """Steps at which trials are compared: first, first * eta, ... below ``last``, where the rest is done."""
    made = []
    while first < last:
        made.append(first)
        first *= eta
    return made


def brackets(last: int, eta: int) -> list[tuple[int, int, float]]:
    """(bracket, first step, share of the trials) of Hyperband: from one rung per power of eta down to no rung at all.

    Bracket s starts at ``last`` / eta ** s; the shares give every bracket about the same number of steps.
    """
    most = 0
    while eta ** (most + 1) <= last:
        most += 1
    sizes = [math.ceil((most + 1) / (s + 1) * eta**s) for s in range(most + 1)]
    return [(s, last // eta**s, n / sum(sizes)) for s, n in enumerate(sizes)]


def with_bracket(steps: DataFrame, last: int, eta: int, key: Sequence[str] = ("trial",), seed: int = 42) -> DataFrame:
    """Add ``bracket`` and ``first``, fixed by the trial's key."""
    share, upto = hash_share(key, seed), 0.0
    bracket = first = None
    for s, start, part in brackets(last, eta):
        upto += part
        inside = share < upto
        bracket = F.when(inside, s) if bracket is None else bracket.when(inside, s)
        first = F.when(inside, start) if first is None else first.when(inside, start)
    return steps.withColumns({"bracket": bracket.otherwise(s), "first": first.otherwise(start)})


def _outcome(steps: DataFrame, by: Sequence[str], stopped: DataFrame | None) -> DataFrame:
    """Every trial with its steps, the step it is stopped at (null: never) and the steps it then runs."""
    trials = steps.groupBy(*by, "trial").agg(F.count(F.lit(1)).alias("n_steps"))
    if stopped is None:
        trials = trials.withColumn("stopped_at", F.lit(None).cast(steps.schema["step"].dataType))
        return trials.withColumn("n_run", F.col("n_steps"))
    met = trials.join(stopped, [*by, "trial"], "left")
    upto = steps.join(stopped, [*by, "trial"], "left").where("stopped_at is null or step <= stopped_at")
    run = upto.groupBy(*by, "trial").agg(F.count(F.lit(1)).alias("n_run"))
    return met.join(run, [*by, "trial"])


def successive_halving(
    steps: DataFrame, last: int, eta: int = 3, first: int | Column = 1, maximize: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """by..., trial, n_steps, stopped_at and n_run: at each rung the best 1 / eta (at least one) of those still there
    go on.

    ``steps`` holds (by..., trial, step, value). All trials of a group are compared when they have reached the rung, by
    value, ties by trial. A trial that ends before a rung by itself, or has no value there, is not compared and not
    stopped. ``first`` may be a column of the group. The border trial of a rung is selected by counting, so no task sorts
    the trials of a group.
    """
    by = list(by)
    start = F.lit(first) if isinstance(first, int) else first
    order = F.col("value").cast("double")
    each = steps.select(*by, "trial", "step", (-order if maximize else order).alias("__order"), start.alias("__first"))
    least = first if isinstance(first, int) else (each.agg(F.min("__first")).first()[0] or last)
    gone = None
    for step in rungs(least, last, eta):
        at = each.where((F.col("step") == step) & (F.col("__first") <= step) & F.col("__order").isNotNull())
        at = written((at if gone is None else at.join(gone, [*by, "trial"], "left_anti")).drop("step", "__first"), "rung")
        group = by or ["__all"]
        at = at if by else at.withColumn("__all", F.lit(0))
        sizes = at.groupBy(F.struct(*group).alias(GROUP)).agg(F.count(F.lit(1)).alias("n"))
        wanted = sizes.select(GROUP, F.greatest(F.floor(F.col("n") / eta), F.lit(1)).cast("long").alias("k"))
        cuts = grouped_cuts(at, group, ["__order", "trial"], wanted)
        out = upto_cuts(at, group, ["__order", "trial"], cuts).where("not __chosen")
        out = written(out.select(*by, "trial", F.lit(step).cast(steps.schema["step"].dataType).alias("stopped_at")), "stopped")
        gone = out if gone is None else gone.union(out)
    return _outcome(steps, by, gone)


def asha(
    steps: DataFrame,
    arrival: str,
    last: int,
    eta: int = 3,
    first: int = 1,
    maximize: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Successive halving as results come in: a trial goes on if, when it reports at a rung, its value is among the best
    1 / eta (at least one, ties included) of what has been reported there so far, its own included.

    ``arrival`` orders the reports (ties by trial). Each decision depends on all before it, so a group's reports at one
    rung pass through one task in order; it keeps their values in two heaps and no rows. Groups run side by side.
    """
    by = list(by)
    order = F.col("value").cast("double")
    each = steps.select(*by, "trial", "step", arrival, (order if maximize else -order).alias("__value"))
    each = each.where(F.col("__value").isNotNull())
    keys, gone = by, None

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[float] = []  # the max(1, seen // eta) largest, smallest first
        rest: list[float] = []  # the others, negated
        seen, group = 0, None
        for frame in frames:
            on = []
            names = frame[keys].itertuples(index=False, name=None) if keys else [()] * len(frame)
            for name, value in zip(names, frame["__value"].tolist()):
                if name != group:
                    best, rest, seen, group = [], [], 0, name
                seen += 1
                heapq.heappush(rest, -heapq.heappushpop(best, value)) if best else best.append(value)
                if len(best) < max(1, seen // eta):
                    heapq.heappush(best, -heapq.heappop(rest))
                on.append(value >= best[0])
            yield frame[[*keys, "trial"]][[not x for x in on]]

    for step in rungs(first, last, eta):
        at = each.where(F.col("step") == step)
        at = at if gone is None else at.join(gone, [*by, "trial"], "left_anti")
        at = (at.repartition(*by) if by else at.repartition(1)).sortWithinPartitions(*by, arrival, "trial")
        schema = T.StructType([at.schema[c] for c in [*by, "trial"]])
        out = at.select(*by, "trial", "__value").mapInPandas(judge, schema)
        out = written(out.withColumn("stopped_at", F.lit(step).cast(steps.schema["step"].dataType)), "stopped")
        gone = out if gone is None else gone.union(out)
    return _outcome(steps, by, gone)


def hyperband(steps: DataFrame, last: int, eta: int = 3, maximize: bool = True, seed: int = 42) -> DataFrame:
    """Successive halving in every bracket of Hyperband: trial, bracket, n_steps, stopped_at and n_run.

    Trials are dealt to brackets by their hash; a bracket that starts late stops nothing early and so covers trials that
    begin slowly.
    """
    dealt = with_bracket(steps, last, eta, seed=seed)
    return successive_halving(dealt, last, eta, F.col("first"), maximize, ["bracket"])


def rung_table(outcome: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trials stopped and steps run per group and rung: what the pruning saves."""
    return outcome.groupBy(*by, "stopped_at").agg(
        F.count(F.lit(1)).alias("n_trials"), F.sum("n_run").alias("n_run"), F.sum("n_steps").alias("n_steps"))
