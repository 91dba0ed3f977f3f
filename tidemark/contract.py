"""Names that every operator shares: the entity key, the time key, feature views and services."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and stored types.
ENTITY = "machine_id"
TIME = "event_timestamp"
READINGS = ("temperature", "vibration", "current")
LABEL = "failure"
FEATURE_COLUMNS = ("temp_roll_mean", "vib_roll_std", "current_roll_mean", "temp_delta")
SERVICE_NAME = "predictive_maintenance_v1"


@dataclass(frozen=True)
class Contract:
    """Which columns identify a reading.

    ``tie`` orders rows that share entity and time; leave it empty when that pair is unique.
    """

    entity: tuple[str, ...] = (ENTITY,)
    time: str = TIME
    tie: tuple[str, ...] = ()

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tie)

    @property
    def key(self) -> tuple[str, ...]:
        return (*self.entity, self.time)


@dataclass(frozen=True)
class FeatureView:
    """Typed columns of one source, keyed by entity and time, valid for ``ttl``."""

    name: str
    schema: T.StructType
    contract: Contract = field(default_factory=Contract)
    ttl: timedelta | None = None

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields)

    def check(self, df: DataFrame) -> None:
        """Raise when the source lacks a key or feature column or a feature has another type."""
        missing = [c for c in (*self.contract.key, *self.features) if c not in df.columns]
        if missing:
            raise ValueError(f"view {self.name}: missing columns {missing}")
        for f in self.schema.fields:
            actual = df.schema[f.name].dataType
            if actual != f.dataType:
                raise ValueError(
                    f"view {self.name}: {f.name} is {actual.simpleString()}, declared {f.dataType.simpleString()}"
                )

    def conform(self, df: DataFrame) -> DataFrame:
        """Keys and features only, features cast to the declared (store) types."""
        missing = [c for c in (*self.contract.key, *self.features) if c not in df.columns]
        if missing:
            raise ValueError(f"view {self.name}: missing columns {missing}")
        typed = [df[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return df.select(*self.contract.key, *self.contract.tie, *typed)


@dataclass(frozen=True)
class FeatureService:
    """A named bundle of views."""

    name: str
    views: tuple[FeatureView, ...]


def resolve_features(
    views: Iterable[FeatureView],
    features: Sequence[str] | None = None,
    service: FeatureService | None = None,
) -> dict[str, list[str]]:
    """Feature names per view. An explicit ``view:feature`` list wins over the service."""
    known = {v.name: v for v in views}
    if features is None:
        if service is None:
            raise ValueError("give a feature list or a service")
        return {v.name: list(v.features) for v in service.views}
    chosen: dict[str, list[str]] = {}
    for ref in features:
        view, _, name = ref.partition(":")
        if view not in known or name not in known[view].features:
            raise ValueError(f"unknown feature {ref}")
        chosen.setdefault(view, []).append(name)
    return chosen


def predictive_maintenance(ttl: timedelta) -> FeatureService:
    """The sensor feature view and its service; the store keeps features as floats."""
    schema = T.StructType([T.StructField(c, T.FloatType()) for c in FEATURE_COLUMNS])
    view = FeatureView("sensor_features", schema, Contract(), ttl)
    return FeatureService(SERVICE_NAME, (view,))
