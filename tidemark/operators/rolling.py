"""Drift of the last hours, tick by tick, from mergeable counts: no row is read twice."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.exprs import ks_p_value
from tidemark.functions.times import micros
from tidemark.operators.drift import CURRENT_WINDOW, P_THRESHOLD
from tidemark.operators.monitoring import TIME, sliding_sums, step_sums
from tidemark.plans.distribution import count_sides, long_values, with_running
from tidemark.plans.scratch import written

STEP = timedelta(hours=1)
CELLS = 1000


@dataclass(frozen=True)
class Grid:
    """Sorted values of a reference column, and the share of the reference up to each cell that they cut.

    Cell 2i + 1 holds what equals value i, cell 2i + 2 what lies between it and the next, cell 0 what lies below all.
    """

    values: np.ndarray
    upto: np.ndarray
    rows: int

    def cell(self, x: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.values, x, "left") + np.searchsorted(self.values, x, "right")


def reference_grids(reference: DataFrame, columns: Sequence[str], cells: int = CELLS) -> dict[str, Grid]:
    """A grid per column with at most ``cells`` values and one for the largest.

    A column with no more distinct values keeps them all: distances from such a grid are exact. Of others the values at
    equal steps of rank are kept, and the distance misses less than 1 / ``cells``. What comes to the driver is as large
    as the grids. A column without values has an empty grid and never drifts.
    """
    sides = count_sides(long_values(reference.withColumn("__ref", F.lit(True)), columns, ["__ref"]), [])
    sides = written(sides, "reference-counts")
    distinct = {r[0]: r[1] for r in sides.groupBy("feature").count().collect()}
    running = with_running(sides, [])
    step = F.floor(F.col("cum_ref") * cells / F.col("n_ref"))
    before = F.floor((F.col("cum_ref") - F.col("ref")) * cells / F.col("n_ref"))
    every = F.col("feature").isin([c for c in columns if distinct.get(c, 0) <= cells])
    kept = running.where(every | (step > before)).select("feature", "value", "cum_ref", "n_ref").collect()
    grids = {}
    for column in columns:
        rows = sorted((float(r.value), int(r.cum_ref), int(r.n_ref)) for r in kept if r.feature == column)
        shares = [0.0] + [x for _, upto, n in rows for x in (upto / n, upto / n)]
        grids[column] = Grid(np.array([r[0] for r in rows]), np.array(shares), rows[0][2] if rows else 0)
    return grids


def cell_counts(log: DataFrame, grids: Mapping[str, Grid], step: timedelta = STEP, watermark: str | None = None) -> DataFrame:
    """(feature, cell, ts, n): rows per column, cell and step. Missing values and NaN are not counted."""

    def placed(column: str):
        grid = grids[column]

        @F.pandas_udf("int")
        def cell(x: pd.Series) -> pd.Series:
            made = grid.cell(x.to_numpy(dtype=float, na_value=np.nan))
            return pd.Series(made).where(x.notna().to_numpy()).astype("Int32")

        return F.struct(F.lit(column).alias("feature"), cell(F.col(column).cast("double")).alias("cell"))

    known = [c for c in grids if grids[c].rows]
    lines = F.array(*[placed(c) for c in known]) if known else F.array().cast("array<struct<feature:string,cell:int>>")
    long = log.select(TIME, F.explode(lines).alias("line")).select(TIME, "line.*").where("cell is not null")
    return step_sums(long, {"n": F.lit(1)}, ["feature", "cell"], step, watermark)


def _tested(found: DataFrame, alpha: float) -> DataFrame:
    p = ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_cur"))
    tested = found.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < alpha)
    return tested.select("feature", "tick", "n_ref", "n_cur", "statistic", "p_value", "drifted")


def rolling_drift(
    log: DataFrame,
    grids: Mapping[str, Grid],
    window: timedelta = CURRENT_WINDOW,
    step: timedelta = STEP,
    alpha: float = P_THRESHOLD,
) -> DataFrame:
    """Kolmogorov-Smirnov drift of the rows of the last ``window`` against the reference, per column at every ``step``.

    The log is read once, for counts by step and cell; only these are copied into the windows they belong to. The cells
    of one column and tick, a fixed number, are ordered in one task. Ticks without rows have no row.
    """
    spark = log.sparkSession
    schema = "feature string, upto array<double>, n_ref long"
    upto = spark.createDataFrame([(c, g.upto.tolist(), g.rows) for c, g in grids.items()], schema)
    counts = written(cell_counts(log, grids, step), "cells")
    kind = log.schema[TIME].dataType
    sums = sliding_sums(counts, ["n"], ["feature", "cell"], window, step)
    group = Window.partitionBy("feature", "tick")
    ordered = group.orderBy("cell")
    sums = sums.withColumns({
        "n_cur": F.sum("n").over(group),
        "before": F.sum("n").over(ordered) - F.col("n"),
        "after": F.sum("n").over(ordered),
        "next": F.lead("cell").over(ordered),
    })
    sums = sums.join(F.broadcast(upto), "feature")
    share = lambda cell: F.get("upto", cell)
    # between two cells that hold rows the current share stands still, so only the ends count
    gaps = F.greatest(
        F.abs(F.col("after") / F.col("n_cur") - share(F.col("cell"))),
        F.abs(F.col("after") / F.col("n_cur") - share(F.coalesce(F.col("next"), F.size("upto")) - 1)),
        F.when(F.col("before") == 0, F.coalesce(share(F.col("cell") - 1), F.lit(0.0))).otherwise(0.0),
    )
    found = sums.groupBy("feature", F.col("tick").cast(kind).alias("tick")).agg(
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"), F.max(gaps).alias("statistic"))
    return _tested(found, alpha)


class RollingCounts(StatefulProcessor):
    """The counts of the last window by cell: a step is added when its tick comes and taken off when it leaves.

    State per column: one entry per step of the window (cells and counts of that step) and the totals, as long as the
    grid. A timer per column waits for the next tick.
    """

    def __init__(self, grids: Mapping[str, Grid], window: int, step: int):
        self.grids, self.window, self.step = dict(grids), window, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.steps = handle.getMapState("steps", "tick long", "cells binary, counts binary")
        self.totals = handle.getValueState("totals", "next long, started boolean, heard long, counts binary")

    def _step(self, tick: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.steps.containsKey((tick,)):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cells, counts = self.steps.getValue((tick,))
        return np.frombuffer(bytes(cells), np.int64), np.frombuffer(bytes(counts), np.int64)

    def _put(self, tick: int, cells: np.ndarray, counts: np.ndarray) -> None:
        known, has = self._step(tick)
        made, of = np.unique(np.concatenate((known, cells)), return_inverse=True)
        total = np.zeros(len(made), np.int64)
        np.add.at(total, of, np.concatenate((has, counts)))
        self.steps.updateValue((tick,), (bytearray(made.tobytes()), bytearray(total.tobytes())))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.totals.get() if self.totals.exists() else None
        first = last = None
        for frame in rows:
            tick = (frame["at"].to_numpy() // self.step + 1) * self.step
            cells, counts = frame["cell"].to_numpy().astype(np.int64), frame["n"].to_numpy().astype(np.int64)
            for t in np.unique(tick).tolist():
                if state is not None and state[1] and t < state[0]:
                    continue
                self._put(t, cells[tick == t], counts[tick == t])
                first, last = t if first is None else min(first, t), t if last is None else max(last, t)
        if first is None:
            return iter([])
        if state is None:
            size = len(self.grids[key[0]].upto)
            self.totals.update((first, False, last, bytearray(np.zeros(size, np.int64).tobytes())))
            self.handle.registerTimer(first // 1000)
        else:
            following = state[0] if state[1] else min(state[0], first)
            if following < state[0]:
                self.handle.deleteTimer(state[0] // 1000)
                self.handle.registerTimer(following // 1000)
            self.totals.update((following, state[1], max(state[2], last), state[3]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        tick, _, heard, counts = self.totals.get()
        total = np.frombuffer(bytes(counts), np.int64).copy()
        grid = self.grids[key[0]]
        while tick <= passed and tick < heard + self.window:
            cells, counts = self._step(tick)
            total[cells] += counts
            cells, counts = self._step(tick - self.window)
            total[cells] -= counts
            self.steps.removeKey((tick - self.window,))
            rows = int(total.sum())
            if rows:
                statistic = float(np.abs(np.cumsum(total) / rows - grid.upto).max())
                yield pd.DataFrame(
                    {"feature": [key[0]], "at": [tick], "n_ref": [grid.rows], "n_cur": [rows], "statistic": [statistic]})
            tick += self.step
        if tick >= heard + self.window:
            for (t,) in list(self.steps.keys()):
                self.steps.removeKey((t,))
            self.totals.clear()
        else:
            self.totals.update((tick, True, heard, bytearray(total.tobytes())))
            self.handle.registerTimer(tick // 1000)

    def close(self) -> None:
        pass


def rolling_drift_stream(
    log: DataFrame,
    grids: Mapping[str, Grid],
    window: timedelta = CURRENT_WINDOW,
    step: timedelta = STEP,
    alpha: float = P_THRESHOLD,
) -> DataFrame:
    """The rows of `rolling_drift` from a watermarked stream, each as soon as the watermark has passed its tick."""
    us = lambda t: int(t / timedelta(microseconds=1))
    rows = cell_counts(log, grids, step).select("feature", micros(TIME).alias("at"), "cell", "n")
    out = T.StructType([
        T.StructField("feature", T.StringType()), T.StructField("at", T.LongType()), T.StructField("n_ref", T.LongType()),
        T.StructField("n_cur", T.LongType()), T.StructField("statistic", T.DoubleType())])
    counts = RollingCounts(grids, us(window), us(step))
    found = rows.groupBy("feature").transformWithStateInPandas(counts, out, "Append", "EventTime")
    tick = F.timestamp_micros("at").cast(log.schema[TIME].dataType)
    return _tested(found.withColumn("tick", tick), alpha)
