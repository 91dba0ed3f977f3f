"""Monitoring over the inference log (ts, model, status, error_type, latency_s, prediction).

Every windowed function takes a batch table or a stream; a stream needs a watermark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import micros, watermarked
from tidemark.plans.scratch import written

# Histogram bounds, evaluation window and step, rate floor, prediction baseline, alert rules.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
PREDICTION_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
RATE_WINDOW, RATE_STEP = timedelta(minutes=5), timedelta(seconds=30)
SHIFT_WINDOW = timedelta(minutes=30)
RATE_FLOOR = 1.0
PREDICTION_BASELINE, PREDICTION_TOLERANCE = 0.30, 0.20
TIME = "ts"
#: the model of rules over all models
EVERY_MODEL = "*"


@dataclass(frozen=True)
class AlertRule:
    """``measure`` above (or below) ``limit`` at every tick for ``hold`` raises the alert."""

    name: str
    measure: str
    above: bool
    limit: float
    hold: timedelta

    def condition(self, measured: Column | None = None) -> Column:
        x = F.col(self.measure) if measured is None else measured
        return F.coalesce(x > self.limit if self.above else x < self.limit, F.lit(False))


ALERT_RULES = (
    AlertRule("HighInferenceErrorRate", "error_ratio", True, 0.05, timedelta(minutes=5)),
    AlertRule("HighInferenceLatencyP95", "p95", True, 1.0, timedelta(minutes=10)),
    AlertRule("InferenceTrafficDrop", "qps", False, 0.01, timedelta(minutes=15)),
    AlertRule("PredictionDistributionShift", "shift", True, PREDICTION_TOLERANCE, timedelta(minutes=30)),
)


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("model", "status").agg(F.count(F.lit(1)).alias("n"))


def error_counts(log: DataFrame) -> DataFrame:
    errors = log.where(F.col("status") == "error")
    return errors.groupBy("model", "error_type").agg(F.count(F.lit(1)).alias("n"))


def _bucket_counts(x: Column, bounds: Sequence[float]) -> dict[str, Column]:
    """Cumulative bucket indicators: 1 when the value is at most the bound."""
    return {f"le_{i}": (x <= F.lit(b)).cast("long") for i, b in enumerate(bounds)}


def histogram(log: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ("model",)) -> DataFrame:
    """Cumulative histogram as (by..., le, n); the last bound is +Inf. One pass, one row per group and bound."""
    rows = log.where(F.col(value).isNotNull())
    sums = [F.sum(c).alias(n) for n, c in _bucket_counts(F.col(value), bounds).items()]
    wide = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("all"), *sums)
    lines = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"le_{i}").alias("n")) for i, b in enumerate(bounds)]
    lines.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("n")))
    return wide.select(*by, F.inline(F.array(*lines)))


def latency_histogram(log: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    return histogram(log, "latency_s", bounds)


def prediction_histogram(log: DataFrame, bounds: Sequence[float] = PREDICTION_BOUNDS) -> DataFrame:
    return histogram(log, "prediction", bounds)


def _text(width: timedelta) -> str:
    return f"{int(width / timedelta(microseconds=1))} microseconds"


def windowed_sums(
    log: DataFrame,
    measures: Mapping[str, Column],
    by: Sequence[str],
    window: timedelta,
    step: timedelta,
    watermark: str | None = None,
) -> DataFrame:
    """Sums per group over sliding windows, one row per group and evaluation tick (the window end).

    The log is first summed per step, so that only those few rows, not the log, are copied into the overlapping
    windows; in a stream the two sums are chained, and late rows are cut off by the watermark.
    """
    kind = log.schema[TIME].dataType
    if window > step and (window / step).is_integer():
        cells = step_sums(log, measures, by, step, watermark)
    else:
        cells = log.withColumns(dict(measures)).select(*by, TIME, *measures)
        cells = watermarked(cells, TIME, watermark) if watermark and log.isStreaming else cells
    sums = sliding_sums(cells, list(measures), by, window, step)
    return sums.withColumn("tick", F.col("tick").cast(kind))


def step_sums(
    log: DataFrame, measures: Mapping[str, Column], by: Sequence[str], step: timedelta, watermark: str | None = None
) -> DataFrame:
    """Sums per group and step; the time of a step is a moment inside it."""
    rows = log.withColumns(dict(measures)).select(*by, TIME, *measures)
    rows = watermarked(rows, TIME, watermark) if watermark and log.isStreaming else rows
    cells = rows.groupBy(*by, F.window(TIME, _text(step)).alias("__cell")).agg(*[F.sum(n).alias(n) for n in measures])
    inside = F.window_time("__cell") if log.isStreaming else F.col("__cell.start")
    return cells.select(*by, inside.alias(TIME), *measures)


def sliding_sums(
    cells: DataFrame, names: Sequence[str], by: Sequence[str], window: timedelta, step: timedelta
) -> DataFrame:
    """Sums per group and window over step sums, with the window's end as ``tick``."""
    sliding = F.window(TIME, _text(window), _text(step)).alias("__w")
    sums = cells.groupBy(*by, sliding).agg(*[F.sum(n).alias(n) for n in names])
    return sums.select(*by, F.col("__w.end").alias("tick"), *names)


def with_silence(ticks: DataFrame, by: Sequence[str], step: timedelta, counts: Sequence[str], tick: str = "tick") -> DataFrame:
    """Every step from a group's first tick to the last tick of all groups; the added ticks have zero ``counts``.

    Counters persist, so silence is a rate of zero, not a missing tick. Each row makes the ticks up to the next one.
    """
    one = F.lit(step)
    end = ticks.agg(F.max(tick)).scalar() + one
    following = F.lead(tick).over(Window.partitionBy(*by).orderBy(tick))
    reach = ticks.withColumn("__until", F.coalesce(following, end) - one)
    spread = F.posexplode(F.sequence(F.col(tick), F.col("__until"), one)).alias("__nth", "__tick")
    rows = reach.select(*by, *counts, spread)
    kept = [F.when(F.col("__nth") == 0, F.col(c)).otherwise(F.lit(0).cast(ticks.schema[c].dataType)).alias(c) for c in counts]
    return rows.select(*by, F.col("__tick").alias(tick), *kept)


def qps(
    log: DataFrame, window: timedelta = RATE_WINDOW, step: timedelta = RATE_STEP, watermark: str | None = None
) -> DataFrame:
    """Requests per second per model, 0 at ticks whose window holds none.

    A stream reports windows with requests; `zero_rates` over the table it has written adds the silent ones.
    """
    sums = windowed_sums(log, {"n": F.lit(1)}, ["model"], window, step, watermark)
    rates = sums.withColumn("qps", F.col("n") / F.lit(window.total_seconds()))
    return rates if log.isStreaming else zero_rates(rates, step)


def zero_rates(rates: DataFrame, step: timedelta = RATE_STEP) -> DataFrame:
    """The table of `qps` with rate 0 at every silent tick up to the last tick of any model."""
    return with_silence(rates, ["model"], step, ["n", "qps"])


def error_ratio(
    log: DataFrame,
    window: timedelta = RATE_WINDOW,
    step: timedelta = RATE_STEP,
    floor: float = RATE_FLOOR,
    by: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Error rate over request rate, the latter at least ``floor`` per second."""
    failed = (F.col("status") == "error").cast("long")
    sums = windowed_sums(log, {"n": F.lit(1), "errors": failed}, by, window, step, watermark)
    seconds = F.lit(window.total_seconds())
    below = F.greatest(F.col("n") / seconds, F.lit(float(floor)))
    return sums.withColumn("error_ratio", (F.col("errors") / seconds) / below)


def quantile_from_buckets(q: float, bounds: Sequence[float], counts: Sequence[Column], total: Column) -> Column:
    """Quantile by linear interpolation inside the first cumulative bucket that reaches it.

    Past the last finite bound the answer is that bound. The first bucket starts at 0.
    """
    rank = F.lit(float(q)) * total
    answer = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = F.lit(float(bounds[i - 1]) if i else min(0.0, float(bounds[0])))
        before = counts[i - 1] if i else F.lit(0)
        share = F.try_divide(rank - before, (counts[i] - before).cast("double"))
        inside = low + (F.lit(float(bounds[i])) - low) * F.coalesce(share, F.lit(1.0))
        answer = F.when(counts[i] >= rank, inside).otherwise(answer)
    return F.when(total > 0, answer)


def latency_quantiles(
    log: DataFrame,
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    window: timedelta = RATE_WINDOW,
    step: timedelta = RATE_STEP,
    bounds: Sequence[float] = LATENCY_BOUNDS,
    watermark: str | None = None,
) -> DataFrame:
    """Bucket quantiles of the latency per model and tick, as columns p50, p95, ..."""
    buckets = _bucket_counts(F.col("latency_s"), bounds)
    rows = log.where(F.col("latency_s").isNotNull())
    sums = windowed_sums(rows, {"n": F.lit(1), **buckets}, ["model"], window, step, watermark)
    counts = [F.col(f"le_{i}") for i in range(len(bounds))]
    made = {f"p{q * 100:g}": quantile_from_buckets(q, bounds, counts, F.col("n")) for q in quantiles}
    return sums.select("model", "tick", "n", *[c.alias(n) for n, c in made.items()])


def prediction_shift(
    log: DataFrame,
    baseline: float = PREDICTION_BASELINE,
    tolerance: float = PREDICTION_TOLERANCE,
    window: timedelta = SHIFT_WINDOW,
    step: timedelta = RATE_STEP,
    floor: float = RATE_FLOOR,
    watermark: str | None = None,
) -> DataFrame:
    """Mean prediction per model (with the floored rate below) and its distance from the baseline."""
    rows = log.where(F.col("prediction").isNotNull())
    measures = {"n": F.lit(1), "total": F.col("prediction")}
    sums = windowed_sums(rows, measures, ["model"], window, step, watermark)
    seconds = F.lit(window.total_seconds())
    mean = (F.col("total") / seconds) / F.greatest(F.col("n") / seconds, F.lit(float(floor)))
    shifted = sums.withColumn("mean_prediction", mean).withColumn("shift", F.abs(F.col("mean_prediction") - baseline))
    return shifted.withColumn("shifted", F.col("shift") > tolerance)


def alert_states(
    ticks: DataFrame,
    keys: Sequence[str],
    condition: Column,
    hold: timedelta | Column,
    step: timedelta,
    tick: str = "tick",
) -> DataFrame:
    """State per tick: inactive, pending (condition holds), firing (it has held for ``hold``).

    A missing tick ends a run. ``since`` is the first tick of the run. There is one row per key and
    tick, so a key has as many rows as the time range has steps, whatever the traffic.
    """
    window = Window.partitionBy(*keys).orderBy("__at")
    needed = F.lit(int(hold / timedelta(microseconds=1))) if isinstance(hold, timedelta) else hold
    marked = ticks.select(*keys, tick, condition.alias("__on"), micros(tick).alias("__at"), needed.alias("__hold"))
    gap = F.col("__at") - F.lag("__at").over(window) != int(step / timedelta(microseconds=1))
    starts = F.col("__on") & (~F.lag("__on", 1, False).over(window) | F.coalesce(gap, F.lit(True)))
    runs = marked.withColumn("__first", F.when(starts, F.col(tick)))
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    since = F.when(F.col("__on"), F.last("__first", ignorenulls=True).over(upto))
    runs = runs.withColumn("since", since)
    held = F.col("__at") - micros("since") >= F.col("__hold")
    state = F.when(~F.col("__on"), "inactive").when(held, "firing").otherwise("pending")
    return runs.select(*keys, tick, "since", state.alias("state"))


def alerts(states: DataFrame, keys: Sequence[str], tick: str = "tick") -> DataFrame:
    """One row per raised alert: when the condition began, when it fired, when it last held."""
    on = states.where(F.col("state") != "inactive")
    runs = on.groupBy(*keys, "since").agg(
        F.min(F.when(F.col("state") == "firing", F.col(tick))).alias("fired_at"), F.max(tick).alias("last_tick")
    )
    return runs.where(F.col("fired_at").isNotNull())


def health_rollup(checks: DataFrame, loaded: str = "loaded", tick: str = "tick") -> DataFrame:
    """Per tick "ok" when every model is loaded, else "degraded"."""
    grouped = checks.groupBy(tick).agg(
        F.count(F.lit(1)).alias("n_models"), F.bool_and(F.coalesce(F.col(loaded), F.lit(False))).alias("__ok")
    )
    return grouped.select(tick, "n_models", F.when(F.col("__ok"), "ok").otherwise("degraded").alias("status"))


def rule_ticks(
    log: DataFrame,
    rules: Sequence[AlertRule] = ALERT_RULES,
    window: timedelta = RATE_WINDOW,
    step: timedelta = RATE_STEP,
    shift_window: timedelta = SHIFT_WINDOW,
    floor: float = RATE_FLOOR,
    baseline: float = PREDICTION_BASELINE,
    bounds: Sequence[float] = LATENCY_BOUNDS,
    watermark: str | None = None,
) -> DataFrame:
    """(rule, model, tick, on, hold, silent): whether each rule's condition holds at each tick.

    One table of step sums by model serves all rules; the sums over all models (``*``) come from it too. ``hold`` is in
    microseconds; ``silent`` is the condition of a model without requests where that is the rule's subject, else null.
    """
    measures = {
        "n": F.lit(1), "errors": (F.col("status") == "error").cast("long"),
        "timed": F.col("latency_s").isNotNull().cast("long"),
        **{n: F.coalesce(c, F.lit(0)) for n, c in _bucket_counts(F.col("latency_s"), bounds).items()},
        "predicted": F.col("prediction").isNotNull().cast("long"), "total": F.coalesce("prediction", F.lit(0.0)),
    }
    cells = step_sums(log, measures, ["model"], step, watermark)
    if not log.isStreaming:
        cells = written(cells, "steps")
    kind = log.schema[TIME].dataType
    us = lambda t: int(t / timedelta(microseconds=1))

    def judged(sums: DataFrame, values: Mapping[str, Column], there: Mapping[str, Column]) -> DataFrame:
        """A row per rule and tick from one row per model and tick."""
        lines = [
            F.when(there[r.measure], F.struct(
                F.lit(r.name).alias("rule"), r.condition(values[r.measure]).alias("on"), F.lit(us(r.hold)).alias("hold"),
                (r.condition(F.lit(0.0)) if r.measure == "qps" else F.lit(None).cast("boolean")).alias("silent")))
            for r in rules if r.measure in values
        ]
        rows = sums.select("model", F.col("tick").cast(kind).alias("tick"), F.explode(F.array_compact(F.array(*lines))).alias("r"))
        return rows.select("r.rule", "model", "tick", "r.on", "r.hold", "r.silent")

    seconds, wide_seconds = F.lit(window.total_seconds()), F.lit(shift_window.total_seconds())
    both = cells.withColumn("model", F.explode(F.array("model", F.lit(EVERY_MODEL))))
    short = sliding_sums(both, [n for n in measures if n not in ("predicted", "total")], ["model"], window, step)
    one = F.col("model") != EVERY_MODEL
    counts = [F.col(f"le_{i}") for i in range(len(bounds))]
    short = judged(
        short,
        {"error_ratio": (F.col("errors") / seconds) / F.greatest(F.col("n") / seconds, F.lit(float(floor))),
         "p95": quantile_from_buckets(0.95, bounds, counts, F.col("timed")), "qps": F.col("n") / seconds},
        {"error_ratio": ~one, "p95": one & (F.col("timed") > 0), "qps": one},
    )
    wide = sliding_sums(cells, ["predicted", "total"], ["model"], shift_window, step)
    mean = (F.col("total") / wide_seconds) / F.greatest(F.col("predicted") / wide_seconds, F.lit(float(floor)))
    wide = judged(wide, {"shift": F.abs(mean - baseline)}, {"shift": F.col("predicted") > 0})
    return short.unionByName(wide)


def alert_report(log: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES, step: timedelta = RATE_STEP, **options) -> DataFrame:
    """All raised alerts of the rules: rule, model (``*`` for rules over all models), since, fired_at, last_tick.

    The log is read once, for its step sums. Ticks of a rule and model are ordered in one task: as many as the time
    range has steps, whatever the traffic.
    """
    ticks = rule_ticks(log, rules, step=step, **options)
    keys = ["rule", "model", "hold", "silent"]
    quiet = with_silence(
        ticks.where("silent is not null").withColumn("n", F.lit(1)), keys, step, ["n", "on"])
    quiet = quiet.withColumn("on", F.when(F.col("n") > 0, F.col("on")).otherwise(F.col("silent"))).drop("n")
    ticks = ticks.where("silent is null").unionByName(quiet)
    states = alert_states(ticks, ["rule", "model"], F.col("on"), F.col("hold"), step)
    return alerts(states, ["rule", "model"])
