"""Training and tuning with Spark ML: boosted trees, logistic baseline, forecasters, search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import LABEL, READINGS
from tidemark.operators.evaluation import classification_report, regression_metrics
from tidemark.operators.folded import folded_auc
from tidemark.operators.scoring import positive_probability

# Default tree settings, the light variant, folds of cross validation.
TREE_PARAMS = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "seed": 42}
LIGHT_TREE_PARAMS = {"maxIter": 40, "maxDepth": 2, "seed": 42}
FOLDS = 5
TABLE_METRICS = ("aucpr", "roc_auc", "f1", "rmse")


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")


def tree_classifier(features: Sequence[str] = READINGS, label: str = LABEL, params: Mapping | None = None) -> Pipeline:
    """Boosted trees on the features in fixed order; missing readings are kept as NaN."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assemble, GBTClassifier(labelCol=label, **{**TREE_PARAMS, **(params or {})})])


def logistic_classifier(features: Sequence[str], label: str, params: Mapping | None = None) -> Pipeline:
    """Multinomial logistic regression on standardised features; missing readings take the column's mean."""
    filled = [f"__filled_{c}" for c in features]
    fill = Imputer(inputCols=list(features), outputCols=filled)
    assemble = VectorAssembler(inputCols=filled, outputCol="__raw", handleInvalid="keep")
    scale = StandardScaler(inputCol="__raw", outputCol="features", withMean=True)
    fit = LogisticRegression(labelCol=label, family="multinomial", **{"maxIter": 200, **(params or {})})
    return Pipeline(stages=[fill, assemble, scale, fit])


ESTIMATORS: dict[str, Callable[..., Pipeline]] = {"trees": tree_classifier, "logistic": logistic_classifier}


def estimator(name: str, **options) -> Pipeline:
    """The estimator registered under the name."""
    if name not in ESTIMATORS:
        raise ValueError(f"unknown model {name}; choose from {sorted(ESTIMATORS)}")
    return ESTIMATORS[name](**options)


def fit(df: DataFrame, pipeline: Pipeline, features: Sequence[str], label: str) -> PipelineModel:
    _require(df, [*features, label])
    return pipeline.fit(df)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def naive_forecast(windows: DataFrame, horizon: int) -> DataFrame:
    """Repeat the last known value over the horizon."""
    last = F.element_at("inputs", -1)
    return windows.withColumn("forecast", F.array_repeat(last, horizon))


def seasonal_forecast(windows: DataFrame, season: int, horizon: int) -> DataFrame:
    """Repeat the values one season earlier; needs windows at least as long as the season."""
    n = F.size("inputs")
    steps = [F.element_at("inputs", n - season + 1 + (h % season)) for h in range(horizon)]
    return windows.withColumn("forecast", F.array(*steps))


@dataclass(frozen=True)
class LinearForecaster:
    """One linear model per step of the horizon, all on the same lookback window."""

    models: tuple

    @classmethod
    def fit(cls, windows: DataFrame, horizon: int, regularisation: float = 0.0) -> LinearForecaster:
        rows = windows.withColumn("features", array_to_vector("inputs"))
        rows = rows.select("features", *[F.get("targets", h).alias(f"y{h}") for h in range(horizon)])
        regress = [LinearRegression(labelCol=f"y{h}", regParam=regularisation, solver="normal") for h in range(horizon)]
        return cls(tuple(r.fit(rows) for r in regress))

    def transform(self, windows: DataFrame) -> DataFrame:
        """Add ``forecast``. The coefficients are constants, so this stays a plain projection."""
        steps = []
        for m in self.models:
            weights = F.array(*[F.lit(float(w)) for w in m.coefficients])
            products = F.zip_with("inputs", weights, lambda x, w: x * w)
            steps.append(F.aggregate(products, F.lit(float(m.intercept)), lambda acc, x: acc + x))
        return windows.withColumn("forecast", F.array(*steps))


def sample_space(space: Mapping[str, Mapping], trials: int, seed: int = 42) -> list[dict]:
    """Random settings from a search space of float (optionally log), int (with step) and categorical entries."""
    draw = random.Random(seed)
    made = []
    for _ in range(trials):
        setting = {}
        for name, spec in space.items():
            kind = spec.get("type")
            if kind == "float" and spec.get("log"):
                setting[name] = math.exp(draw.uniform(math.log(spec["low"]), math.log(spec["high"])))
            elif kind == "float":
                setting[name] = draw.uniform(spec["low"], spec["high"])
            elif kind == "int":
                setting[name] = draw.randrange(spec["low"], spec["high"] + 1, spec.get("step", 1))
            elif kind == "categorical":
                setting[name] = draw.choice(list(spec["choices"]))
            else:
                raise ValueError(f"unknown search space type {kind} for {name}")
        made.append(setting)
    return made


class TableMetric(Evaluator):
    """This package's metrics as evaluator of a search: ``aucpr`` is average precision, ``f1`` at a threshold of 0.5,
    ``rmse`` of a regression, where less is better."""

    def __init__(self, metric: str, label: str):
        super().__init__()
        self.metric, self.label = metric, label

    def isLargerBetter(self) -> bool:  # noqa: N802
        return self.metric != "rmse"

    def _evaluate(self, dataset: DataFrame) -> float:
        if self.metric == "rmse":
            value = regression_metrics(dataset, self.label, "prediction").first()["rmse"]
        else:
            scored = positive_probability(dataset).select(self.label, "score")
            value = classification_report(scored, self.label, "score").first()[self.metric]
        return math.nan if value is None else float(value)


def _judge(metric: str, label: str) -> Evaluator:
    if metric in TABLE_METRICS:
        return TableMetric(metric, label)
    return BinaryClassificationEvaluator(labelCol=label, metricName=metric)


def search(
    df: DataFrame,
    pipeline: Pipeline,
    settings: Sequence[Mapping],
    label: str,
    metric: str = "areaUnderROC",
    folds: int | None = None,
    fold_column: str = "",
    parallelism: int = 2,
    seed: int = 42,
) -> tuple[list[tuple[dict, float]], PipelineModel]:
    """Score every setting and refit the best on all rows.

    ``metric`` is one of TABLE_METRICS or a name that Spark's binary evaluator knows. One train/validation split, or cross validation when ``folds`` is given; ``fold_column`` names a
    precomputed fold per row. Settings of ``logistic_classifier`` on such folds share their passes over the rows
    (``folded_auc``).
    """
    last: Estimator = pipeline.getStages()[-1]
    grid = [{last.getParam(k): v for k, v in s.items()} for s in settings]
    if folds and fold_column and metric == "areaUnderROC":
        shared = folded_auc(df, pipeline, settings, label, folds, fold_column)
        if shared is not None:
            return [(dict(s), v) for s, v in zip(settings, shared)], pipeline.fit(df, grid[int(np.argmax(shared))])
    common = dict(estimator=pipeline, estimatorParamMaps=grid, evaluator=_judge(metric, label), parallelism=parallelism, seed=seed)
    if folds:
        tuned = CrossValidator(numFolds=folds, foldCol=fold_column, **common).fit(df)
        scores = tuned.avgMetrics
    else:
        tuned = TrainValidationSplit(trainRatio=0.8, **common).fit(df)
        scores = tuned.validationMetrics
    return [(dict(s), float(v)) for s, v in zip(settings, scores)], tuned.bestModel


def trial_table(spark: SparkSession, results: Sequence[tuple[Mapping, float]]) -> DataFrame:
    """Search results as run rows: number, params map, value. One row per trial."""
    rows = [(i, {k: str(v) for k, v in s.items()}, value) for i, (s, value) in enumerate(results)]
    return spark.createDataFrame(rows, "number long, params map<string,string>, value double")


def holdout_report(model: PipelineModel, test: DataFrame, label: str, threshold: float = 0.5) -> DataFrame:
    """Classification metrics of a fitted model on held-out rows."""
    scored = positive_probability(model.transform(test))
    return classification_report(scored.select(label, "score"), label, "score", threshold)
