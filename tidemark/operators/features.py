"""Window features per entity: rolling statistics, differences, lags, supervised windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.contract import FEATURE_COLUMNS, Contract
from tidemark.operators.quality import dedup_first
from tidemark.plans.ordered import find_slices, running, with_window


@dataclass(frozen=True)
class Feature:
    """One window feature.

    ``mean`` and ``std`` look at ``span`` rows, ending one row back when ``shifted`` and at the row
    itself otherwise (the leaky form, kept for comparison). ``lag`` is the reading ``span`` rows back.
    ``delta`` is the change from the previous row; ``strict`` moves it one row back so that it only
    uses rows before the current one.
    """

    name: str
    source: str
    kind: str
    span: int = 1
    shifted: bool = True
    strict: bool = False

    @property
    def reach(self) -> int:
        if self.kind == "delta":
            return 2 if self.strict else 1
        return self.span

    def column(self, window: WindowSpec) -> Column:
        x = F.col(self.source)
        if self.kind == "lag":
            return F.lag(x, self.span).over(window)
        if self.kind == "delta":
            if self.strict:
                return F.lag(x, 1).over(window) - F.lag(x, 2).over(window)
            return x - F.lag(x, 1).over(window)
        frame = window.rowsBetween(-self.span, -1) if self.shifted else window.rowsBetween(1 - self.span, 0)
        if self.kind == "mean":
            return F.avg(x).over(frame)
        if self.kind == "std":
            return F.stddev_samp(x).over(frame)
        raise ValueError(f"unknown feature kind {self.kind}")


def sensor_features(window: int) -> list[Feature]:
    """The four features of the sensor view, in their fixed order."""
    temp_mean, vib_std, current_mean, temp_delta = FEATURE_COLUMNS
    return [
        Feature(temp_mean, "temperature", "mean", window),
        Feature(vib_std, "vibration", "std", window),
        Feature(current_mean, "current", "mean", window),
        Feature(temp_delta, "temperature", "delta"),
    ]


def build_features(
    df: DataFrame,
    features: Sequence[Feature],
    contract: Contract = Contract(),
    fill: float | None = 0.0,
    reset_at: Sequence[str] = (),
    sizing: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Add the features; rows and input columns stay as they are.

    All features share one shuffle by entity and one sort. Missing history becomes ``fill`` in the
    feature columns only. ``reset_at`` names extra columns (such as the split) where history restarts.
    When ``df`` is costly, ``sizing`` is a cheaper table to count the rows per entity on.
    """
    needed = {*contract.key, *(f.source for f in features)}
    missing = sorted(needed - set(df.columns))
    if missing:
        raise KeyError(f"missing source columns: {missing}")

    def columns(window: WindowSpec) -> dict[str, Column]:
        made = {f.name: f.column(window) for f in features}
        if fill is None:
            return made
        return {name: F.coalesce(c, F.lit(fill)) for name, c in made.items()}

    reach = max((f.reach for f in features), default=0)
    by = [*contract.entity, *reset_at]
    return with_window(df, by, contract.order, columns, before=reach, sizing=sizing, at_most=at_most)


def clean_and_build(
    df: DataFrame, features: Sequence[Feature], contract: Contract, fill: float | None = 0.0
) -> DataFrame:
    """Keep the first row per entity and time, then add the features.

    Without an oversized entity the rows are shuffled by entity once: de-duplication and windows then
    share that partitioning and its sort. Otherwise copies collapse before the shuffle, and the
    windows run on slices.
    """
    keys = df.select(*contract.entity, *contract.order)
    if find_slices(keys, contract.entity, contract.order) is None:
        clean = dedup_first(df.repartition(*contract.entity), contract)
        return build_features(clean, features, contract, fill, at_most=0)
    return build_features(dedup_first(df, contract), features, contract, fill, sizing=keys)


def leak_compare(df: DataFrame, sources: Sequence[str], window: int, contract: Contract = Contract()) -> DataFrame:
    """Each reading at t beside its lagged mean; rows without history are dropped."""
    lagged = [Feature(f"{c}__ok", c, "mean", window) for c in sources]
    both = build_features(df, lagged, contract, fill=None)
    both = both.withColumns({f"{c}__leak": F.col(c) for c in sources})
    return both.dropna(subset=[f"{c}__{side}" for c in sources for side in ("ok", "leak")])


def supervised_windows(
    df: DataFrame, value: str, lookback: int, horizon: int, contract: Contract = Contract()
) -> DataFrame:
    """One sample per position: ``inputs`` (the last ``lookback`` readings) and ``targets`` (the next ``horizon``).

    Windows stay inside one entity. An entity with n rows gives n - lookback - horizon + 1 samples.
    """
    if lookback < 1 or horizon < 1:
        raise ValueError("lookback and horizon must be at least 1")
    reading = F.struct(F.col(value).alias("v"))

    def columns(window: WindowSpec) -> dict[str, Column]:
        return {
            "inputs": F.collect_list(reading).over(window.rowsBetween(1 - lookback, 0))["v"],
            "targets": F.collect_list(reading).over(window.rowsBetween(1, horizon))["v"],
        }

    made = with_window(
        df.select(*contract.entity, *contract.order, value),
        contract.entity,
        contract.order,
        columns,
        before=lookback,
        after=horizon,
    )
    full = (F.size("inputs") == lookback) & (F.size("targets") == horizon)
    return made.where(full).drop(value)


def expanding_mean(df: DataFrame, value: str, contract: Contract = Contract(), name: str = "mean") -> DataFrame:
    """Mean of all readings of the entity up to and including the row."""
    sums = {"__total": ("sum", F.col(value)), "__seen": ("sum", F.col(value).isNotNull().cast("long"))}
    totals = running(df, contract.entity, contract.order, sums)
    return totals.withColumn(name, F.try_divide("__total", "__seen")).drop("__total", "__seen")


def head_per_entity(df: DataFrame, n: int, contract: Contract = Contract()) -> DataFrame:
    """The first ``n`` rows of each entity by time.

    The rank filter is applied before the shuffle as well, so each task sends at most ``n`` rows per
    entity however many an entity has.
    """
    window = Window.partitionBy(*contract.entity).orderBy(*contract.order)
    ranked = df.withColumn("__row", F.row_number().over(window))
    return ranked.where(F.col("__row") <= n).drop("__row")


def entity_correlation(df: DataFrame, value: str, label: str, contract: Contract = Contract()) -> DataFrame:
    """Correlation, across entities, of the mean reading with the label rate."""
    per_entity = df.groupBy(*contract.entity).agg(F.avg(value).alias("mean_value"), F.avg(label).alias("label_rate"))
    return per_entity.agg(
        F.count(F.lit(1)).alias("n_entities"), F.corr("mean_value", "label_rate").alias("correlation")
    )
