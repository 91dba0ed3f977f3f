"""Predictions meet their late labels while both arrive."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import watermarked


def label_feedback(
    predictions: DataFrame,
    labels: DataFrame,
    entity: Sequence[str],
    ids: Sequence[str],
    horizon: timedelta,
    time: str = "ts",
    label_time: str = "ts",
    delay: str | None = "10 minutes",
    label_delay: str | None = "1 hour",
) -> DataFrame:
    """Every prediction once, with ``label`` 1 if a label of its entity came at most ``horizon`` after it, else 0.

    An interval join of two streams with a watermark each: labels may run later than predictions. A matched prediction
    comes out with its first match, an unmatched one when both watermarks have passed its horizon; until then it is kept
    in the state, a label until predictions before it can no longer come. ``ids`` name a prediction: repeats of it, and
    further labels, add no rows. A null entity matches nothing. A delay is None for a stream that has its watermark.
    Works on tables too.
    """
    entity, ids = list(entity), list(ids)
    kind = predictions.schema[time].dataType
    if predictions.isStreaming:
        predictions = watermarked(predictions, time, delay) if delay else predictions
        labels = watermarked(labels, label_time, label_delay) if label_delay else labels
    names = {c: f"__label_{c}" for c in [*entity, label_time]}
    seen = labels.select(*[F.col(c).alias(n) for c, n in names.items()])
    at = F.col(names[label_time])
    near = (at >= F.col(time)) & (at <= F.col(time) + F.lit(horizon))
    for c in entity:
        near = near & (F.col(c) == F.col(names[c]))
    joined = predictions.join(seen, near, "left_outer")
    labelled = joined.select(*predictions.columns, at.isNotNull().cast("int").alias("label"))
    return labelled.dropDuplicates([*ids, time]).withColumn(time, F.col(time).cast(kind))
