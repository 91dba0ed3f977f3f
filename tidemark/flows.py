"""The end-to-end jobs: sensor log to feature table, feature table to a gated model, probes to a rollout."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tidemark.contract import FEATURE_COLUMNS, LABEL, READINGS, Contract
from tidemark.operators.evaluation import DEFAULT_GATE, metrics_long, quality_gate
from tidemark.operators.features import clean_and_build, sensor_features
from tidemark.operators.models import estimator, fit, holdout_report
from tidemark.operators.quality import validate_sensors
from tidemark.operators.runs import CANARY_THRESHOLD, canary_decision
from tidemark.operators.splits import temporal_split
from tidemark.sources.tables import feature_table, write_feature_table

# Rolling window of the feature stage, hold-out share.
ROLLING_WINDOW = 6
TEST_SHARE = 0.2


def feature_flow(
    sensors: DataFrame, path: str, contract: Contract = Contract(), window: int = ROLLING_WINDOW, label: str = LABEL
) -> DataFrame:
    """Validate the log in one aggregate pass, clean it, add the features and write the feature table."""
    validate_sensors(sensors, contract, label=label)
    made = clean_and_build(sensors, sensor_features(window), contract)
    write_feature_table(feature_table(made, [*READINGS, *FEATURE_COLUMNS], contract, label), path, contract)
    return sensors.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Trained:
    """A fitted model, its hold-out metrics (metric, value), and the one-row gate result."""

    model: PipelineModel
    metrics: DataFrame
    gate: DataFrame


def training_flow(
    table: DataFrame,
    model: str = "trees",
    params: dict | None = None,
    features: Sequence[str] = (*READINGS, *FEATURE_COLUMNS),
    label: str = LABEL,
    contract: Contract = Contract(),
    test: float = TEST_SHARE,
    gate: tuple[str, float] = DEFAULT_GATE,
) -> Trained:
    """Train on the earlier rows, evaluate on the later ones, judge the gate metric."""
    split = temporal_split(table, test, contract=contract)
    fitted = fit(
        split.where("split = 'train'"), estimator(model, features=features, label=label, params=params), features, label
    )
    metrics = metrics_long(holdout_report(fitted, split.where("split = 'test'"), label))
    return Trained(fitted, metrics, quality_gate(metrics, *gate))


def rollout(probes: DataFrame, targets: DataFrame, threshold: float = CANARY_THRESHOLD) -> DataFrame:
    """Promote or roll back every target by its probe log."""
    return canary_decision(probes, targets, threshold=threshold)
