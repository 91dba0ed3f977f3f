"""Batch scoring arithmetic: probabilities, decisions, image scaling, request batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import READINGS
from tidemark.functions.exprs import argmax, sigmoid, softmax

# Image channel statistics, decision labels, default threshold.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)
DEFECT_LABELS = ("good", "defect")
THRESHOLD = 0.5


def defect_probability(logits: Column) -> Column:
    """Two logits: softmax, second class. One logit: sigmoid."""
    doubles = F.transform(logits, lambda x: x.cast("double"))
    return F.when(F.size(logits) == 2, F.get(softmax(doubles), 1)).otherwise(sigmoid(F.get(doubles, 0)))


def defect_decision(df: DataFrame, logits: Column, threshold: float = THRESHOLD) -> DataFrame:
    good, defect = DEFECT_LABELS
    scored = df.withColumn("defect_probability", defect_probability(logits))
    hit = F.col("defect_probability") >= F.lit(threshold)
    return scored.withColumn("decision", F.when(hit, defect).otherwise(good))


def classify(df: DataFrame, logits: Column, names: Sequence[str]) -> DataFrame:
    """Add the winning class, its name, and the probability of every class by name."""
    doubles = F.transform(logits, lambda x: x.cast("double"))
    labels = F.array(*[F.lit(n) for n in names])
    return df.withColumns({"class_id": argmax(doubles), "__p": softmax(doubles)}).select(
        *df.columns,
        "class_id",
        F.get(labels, F.col("class_id")).alias("class_name"),
        F.map_from_arrays(labels, F.col("__p")).alias("probabilities"),
    )


def normalize_channels(df: DataFrame, pixels: Column, height: Column | int, width: Column | int) -> DataFrame:
    """Pixel values 0-255 in row, column, channel order to standardised channel, row, column order.

    Adds ``channels``, one array per channel. Images that are not height x width x 3 are left out.
    """
    size = (height if isinstance(height, Column) else F.lit(height)) * width * 3
    checked = df.withColumn("__pixels", pixels).where(F.size("__pixels") == size)

    def channel(c: int) -> Column:
        own = F.filter("__pixels", lambda x, i: i % 3 == c)
        return F.transform(own, lambda x: (x.cast("double") / 255.0 - CHANNEL_MEAN[c]) / CHANNEL_STD[c])

    return checked.withColumn("channels", F.array(*[channel(c) for c in range(3)])).drop("__pixels")


def feature_vector(df: DataFrame, features: Sequence[str] = READINGS, name: str = "features") -> DataFrame:
    """The readings as one array in fixed order; a missing column is an error."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"missing features {missing}")
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in features]))


def positive_probability(df: DataFrame, probability: str = "probability", name: str = "score") -> DataFrame:
    """Probability of the positive class, from a probability vector or a plain number."""
    if df.schema[probability].dataType.typeName() in ("double", "float"):
        return df.withColumn(name, F.col(probability).cast("double"))
    return df.withColumn(name, F.get(vector_to_array(probability), 1))


def score_readings(model: Model, df: DataFrame, keys: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """Failure probability and flag beside the keys of each reading."""
    scored = positive_probability(model.transform(df), name="failure_probability")
    return scored.select(*keys, "failure_probability", (F.col("failure_probability") >= threshold).alias("will_fail"))


def explode_requests(requests: DataFrame, request: str, readings: str = "readings") -> DataFrame:
    """One row per reading of a request, with its position."""
    rows = requests.select(request, F.posexplode(readings).alias("position", "__r"))
    return rows.select(request, "position", "__r.*")


def gather_responses(scored: DataFrame, request: str, entity: str, position: str = "position") -> DataFrame:
    """Predictions of each request (at most 1000 items) back in the order they were asked."""
    item = F.struct(position, entity, "failure_probability", "will_fail")
    grouped = scored.groupBy(request).agg(F.array_sort(F.collect_list(item)).alias("predictions"))
    return grouped.withColumn("predictions", F.transform("predictions", lambda p: p.dropFields(position)))
