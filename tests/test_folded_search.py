"""Cross validation whose settings and folds share their passes, beside Spark's own search."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tidemark.operators import folded
from tidemark.operators import models as md

FEATURES = ["a", "b", "c", "flat"]
SETTINGS = [{"regParam": r, "elasticNetParam": e, "maxIter": 100} for r, e in
            [(0.0, 0.0), (0.001, 0.0), (0.3, 0.0), (0.01, 0.5), (0.05, 1.0), (0.2, 0.5), (30.0, 0.5)]]


def _rows(n, gaps=True, seed=3):
    draw = random.Random(seed)
    made = []
    for i in range(n):
        a, b = draw.gauss(50, 9), draw.gauss(0, 0.01)
        c = a / 9 + draw.gauss(0, 2)
        y = draw.random() < 1 / (1 + math.exp(-(a - 50) / 9 + 90 * b))
        if gaps and i % 7 == 3:
            a = None if i % 2 else math.nan
        made.append((i, i * 7 % 3, a, b, float(round(c)), 0.1, int(y)))
    return made


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, flat double, y int")


def _pipeline():
    return md.estimator("logistic", features=FEATURES, label="y", params={"tol": 1e-12})


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("gaps", [False, True])
def test_shared_passes_give_the_scores_of_sparks_search(spark, gaps):
    df = _frame(spark, _rows(900, gaps)).cache()
    pipeline, settings = _pipeline(), SETTINGS[::2]
    results, best = md.search(df, pipeline, settings, "y", folds=3, fold_column="fold")
    last = pipeline.getStages()[-1]
    grid = [{last.getParam(k): v for k, v in s.items()} for s in settings]
    own = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=md._judge("areaUnderROC", "y"), numFolds=3,
                         foldCol="fold", parallelism=4).fit(df)
    assert [s for s, _ in results] == settings
    assert [v for _, v in results] == pytest.approx(own.avgMetrics, abs=2e-5)
    assert results[-1][1] == 0.5 and max(own.avgMetrics) > 0.6
    assert best.stages[-1].coefficientMatrix.toArray() == pytest.approx(own.bestModel.stages[-1].coefficientMatrix.toArray(), abs=1e-6)


def test_coefficients_are_those_of_sparks_fits(spark):
    df = _frame(spark, _rows(900)).cache()
    pipeline = _pipeline()
    packed = folded.blocks(df, FEATURES, "y", 3, "fold")
    m = folded.moments(packed, 3, len(FEATURES))
    design = folded.Design.over(m)
    assert design.gaps == (0,)
    made = folded.fits(packed, m, design, folded.penalties(pipeline, SETTINGS, "y"))
    for k in (1, 3, 5):
        model = pipeline.fit(df.where("fold <> 1"), {pipeline.getStages()[-1].getParam(n): v for n, v in SETTINGS[k].items()})
        matrix, shift = model.stages[-1].coefficientMatrix.toArray(), model.stages[-1].interceptVector
        theta = np.concatenate([[shift[1] - shift[0]], matrix[1] - matrix[0]])
        assert made[1][k] == pytest.approx(design.change(*m.of([0, 2])) @ theta, abs=1e-5)


def test_jobs_do_not_grow_with_the_settings(spark):
    """Before, 24 settings on 3 folds took a fit and a sort each: some thousand jobs."""
    df = _frame(spark, _rows(300)).cache()
    df.count()
    settings = md.sample_space({"regParam": {"type": "float", "low": 0.01, "high": 1.0, "log": True},
                                "elasticNetParam": {"type": "categorical", "choices": [0.0, 0.5]}}, 24)
    few = _jobs(spark, "few", lambda: md.search(df, _pipeline(), settings[:2], "y", folds=3, fold_column="fold"))
    many = _jobs(spark, "many", lambda: md.search(df, _pipeline(), settings, "y", folds=3, fold_column="fold"))
    assert 0 < many < few + 60


def test_areas_are_exact_over_blocks_ranges_rounds_and_ties(spark, monkeypatch):
    rows = [(i, f, float(round(a)), b, c, d, y) for i, f, a, b, c, d, y in _rows(1500, False)]
    df = _frame(spark, rows + rows[:400]).repartition(5)
    monkeypatch.setattr(folded, "BLOCK_BYTES", 8 * 4 * 64)
    monkeypatch.setattr(folded, "RANGE_ROWS", 100)
    monkeypatch.setattr(folded, "ROUND_SETTINGS", 2)
    monkeypatch.setattr(folded, "ROUND_BYTES", 1)
    packed = folded.blocks(df, FEATURES, "y", 3, "fold")
    assert packed.agg(F.sum("n")).first()[0] == 1900 and packed.count() > 20
    m = folded.moments(packed, 3, 4)
    design = folded.Design.over(m)
    weights = [[1.0, 0.0, 0.0, 0.0], [0.0, 0.0, -2.0, 0.0], [0.5, -1.0, 0.25, 0.0], [0.0, 0.0, 0.0, 0.0], [1.0, 0.0, 1.0, 0.0]]
    models = [[np.array([0.3, *w]) for w in weights] for _ in range(3)]
    found = folded.areas(packed, m, design, models)
    every = rows + rows[:400]
    for f in range(3):
        x = np.array([r[2:6] for r in every if r[1] == f]).T
        y = np.array([r[6] for r in every if r[1] == f])
        for k, w in enumerate(weights):
            s = folded._scores(design.matrix(x), np.array([[0.0, *w]]))[0]
            high, low = s[y == 1][:, None], s[y == 0][None]
            assert found[f, k] == pytest.approx(((high > low) + (high == low) / 2).mean(), abs=1e-12)
    assert (found[:, 3] == 0.5).all()


def test_one_class_in_a_fold_and_what_is_left_to_spark(spark):
    rows = [(*r[:6], 0) if r[1] == 2 else r for r in _rows(300)]
    own = folded.folded_auc(_frame(spark, rows), _pipeline(), SETTINGS[2:4], "y", 3, "fold")
    last = (pipeline := _pipeline()).getStages()[-1]
    grid = [{last.getParam(k): v for k, v in s.items()} for s in SETTINGS[2:4]]
    spark_own = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=md._judge("areaUnderROC", "y"), numFolds=3, foldCol="fold")
    assert own == pytest.approx(spark_own.fit(_frame(spark, rows)).avgMetrics, abs=2e-5)
    left = lambda df, settings=SETTINGS[2:3], folds=3, pipeline=None: folded.folded_auc(
        df, pipeline or _pipeline(), settings, "y", folds, "fold")
    df = _frame(spark, _rows(60))
    assert left(df, [{"maxIter": 3}]) is None and left(df, [{"tol": 0.1}]) is None
    assert left(df, folds=2) is None and left(df, folds=4) is None
    for column, value in (("y", "2"), ("y", "null"), ("fold", "null"), ("a", "null"), ("b", "double('inf')")):
        changed = F.expr(f"if(id % 20 = 3 or '{column}' = 'a', {value}, {column})").cast(dict(df.dtypes)[column])
        assert left(df.withColumn(column, changed)) is None
    assert left(df.withColumn("y", F.lit(1))) is None and left(df.withColumn("a", F.col("a").cast("float"))) is None
    assert left(df, pipeline=md.estimator("trees", features=FEATURES, label="y", params={"maxIter": 1})) is None
