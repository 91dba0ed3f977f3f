"""Parameter importance by functional variance: what each parameter, and each pair beyond its two, explains."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scratch import written


def leaf_boxes(root, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, value) of the leaves of a fitted tree, each a box of the parameter space cut to ``low`` .. ``high``."""
    found, open_ = [], [(root, low.astype(float), high.astype(float))]
    while open_:
        node, a, b = open_.pop()
        if node.subtreeDepth() == 0:
            found.append((a, b, float(node.prediction())))
            continue
        at, cut = node.split().featureIndex(), float(node.split().threshold())
        left, right = b.copy(), a.copy()
        left[at], right[at] = min(b[at], max(a[at], cut)), max(a[at], min(b[at], cut))
        open_ += [(node.leftChild(), a, left), (node.rightChild(), right, b)]
    return tuple(np.array(x) for x in zip(*found))


def functional_variance(low: np.ndarray, high: np.ndarray, value: np.ndarray) -> tuple[float, dict[tuple[int, ...], float]]:
    """Total variance of a function that is constant on boxes, over their union with even weight, and the parts of each
    dimension and of each pair beyond its two dimensions.

    A marginal is constant between the edges of boxes along its dimensions, so integrals are finite sums. A dimension
    without extent explains nothing.
    """
    span = high.max(axis=0) - low.min(axis=0)
    real = span > 0
    width = np.where(real, (high - low) / np.where(real, span, 1), 1.0)
    volume = width.prod(axis=1)
    mean = float(volume @ value)
    total = float(volume @ (value - mean) ** 2)
    edges = [np.unique(np.concatenate((low[:, d], high[:, d]))) for d in range(low.shape[1])]

    def marginal(d: int) -> tuple[np.ndarray, np.ndarray]:
        """Width of every piece along a dimension, and which boxes cover it."""
        mid = (edges[d][1:] + edges[d][:-1]) / 2
        return np.diff(edges[d]) / span[d], (low[:, d, None] < mid) & (mid < high[:, d, None])

    dims = [d for d in range(low.shape[1]) if real[d]]
    pieces = {d: marginal(d) for d in dims}
    mains, parts = {}, {}
    across = lambda *some: np.delete(width, some, axis=1).prod(axis=1)
    for d in dims:
        step, inside = pieces[d]
        mains[d] = (value * across(d)) @ inside - mean
        parts[(d,)] = float(step @ mains[d] ** 2)
    for d, e in combinations(dims, 2):
        (step_d, in_d), (step_e, in_e) = pieces[d], pieces[e]
        weight = value * across(d, e)
        both = (in_d * weight[:, None]).T @ in_e - mean - mains[d][:, None] - mains[e][None, :]
        parts[(d, e)] = float(step_d @ both**2 @ step_e)
    return total, parts


def param_variance(
    trials: DataFrame, params: Sequence[str], value: str = "value", depth: int = 6, bins: int = 64, min_rows: int = 1
) -> DataFrame:
    """params (one name, or two with a comma), variance and share of the total variance of the value.

    A regression tree, fitted on all trials, cuts the parameter space into at most 2 ** depth boxes; the variance over
    the whole space, evenly weighted, is split into what each parameter explains alone and each pair beyond that. What
    reaches the driver are the boxes. Trials without a value or a parameter are left out; without trials there are no rows.
    """
    spark, params = trials.sparkSession, list(params)
    rows = trials.select(*[F.col(c).cast("double").alias(c) for c in params], F.col(value).cast("double").alias("__value"))
    rows = written(rows.dropna(), "trials")
    spans = rows.agg(*[f(c) for f in (F.min, F.max) for c in params]).first()
    schema = "params string, variance double, share double"
    if spans[0] is None:
        return spark.createDataFrame([], schema)
    low, high = np.array(spans[: len(params)]), np.array(spans[len(params) :])
    tree = DecisionTreeRegressor(
        featuresCol="__features", labelCol="__value", maxDepth=depth, maxBins=bins, minInstancesPerNode=min_rows, seed=7)
    model = tree.fit(VectorAssembler(inputCols=params, outputCol="__features").transform(rows))
    total, parts = functional_variance(*leaf_boxes(model._java_obj.rootNode(), low, high))
    made = [(",".join(params[d] for d in dims), v, v / total if total > 0 else 0.0) for dims, v in parts.items()]
    return spark.createDataFrame(made, schema)
