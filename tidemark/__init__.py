"""Spark-native feature, evaluation and drift operators over per-entity event tables."""

from tidemark.contract import Contract, FeatureService, FeatureView

__all__ = ["Contract", "FeatureService", "FeatureView"]
