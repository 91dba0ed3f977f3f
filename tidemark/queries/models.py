"""Scoring arithmetic on the embeddings table, and models trained on the event log."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.functions.exprs import hash_bucket
from tidemark.operators import evaluation as ev
from tidemark.operators import features as fx
from tidemark.operators import models as md
from tidemark.operators import scoring as sc
from tidemark.operators.splits import hash_split, kfold, temporal_split
from tidemark.plans.scratch import written
from tidemark.queries.base import LOG, events, labelled, rounded
from tidemark.session import table

NAMES = [f"class_{k}" for k in range(64)]


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", "embedding")


@query(
    "defect_decision",
    """
    WITH e AS (SELECT vec_id, embedding[1]::DOUBLE * 10 AS a, embedding[2]::DOUBLE * 10 AS b FROM embeddings),
         p AS (SELECT vec_id, 2 AS n_logits, exp(b - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b)))
                      AS p FROM e
               UNION ALL SELECT vec_id, 1, 1.0::DOUBLE / (1.0::DOUBLE + exp(-a)) FROM e)
    SELECT vec_id, n_logits, round(p, 6) AS defect_probability, CASE WHEN p >= 0.5 THEN 'defect' ELSE 'good' END
           AS decision FROM p
    """,
)
def defect_decision(spark, sf):
    """The first two vector entries as two logits, and the first alone as one."""
    df = _vectors(spark, sf)
    both = df.select("vec_id", F.explode(F.array(F.lit(2), F.lit(1))).alias("n_logits"), "embedding")
    logits = F.transform(F.slice("embedding", 1, F.col("n_logits")), lambda x: x.cast("double") * 10)
    return rounded(sc.defect_decision(both, logits).drop("embedding"))


@query(
    "argmax_softmax",
    """
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
         p AS (SELECT vec_id, list_position(v, list_max(v)) - 1 AS c,
                      list_transform(v, lambda x: exp(x - list_max(v))) AS x FROM e)
    SELECT vec_id, c AS class_id, 'class_' || c AS class_name, 'class_' || i AS name,
           round(x[i + 1] / list_sum(x), 6) AS probability
    FROM p, (SELECT unnest(range(64)) AS i)
    """,
)
def argmax_softmax(spark, sf):
    made = sc.classify(_vectors(spark, sf).select("vec_id", "embedding"), "embedding", NAMES)
    rows = made.select("vec_id", "class_id", "class_name", F.explode("probabilities").alias("name", "probability"))
    return rounded(rows)


@query(
    "channel_normalize",
    """
    WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pixel FROM embeddings)
    SELECT vec_id, CAST(c AS INTEGER) AS channel, CAST(pixel AS INTEGER) AS pixel,
           round(((x::DOUBLE + 1.0) * 127.5 / 255.0 - [0.485, 0.456, 0.406][c + 1]::DOUBLE)
                 / [0.229, 0.224, 0.225][c + 1]::DOUBLE, 6) AS value
    FROM e, (SELECT unnest(range(3)) AS c)
    """,
)
def channel_normalize(spark, sf):
    """Every vector as an 8 x 8 grey image whose three channels hold the same value."""
    grey = F.transform("embedding", lambda x: (x.cast("double") + 1.0) * 127.5)
    pixels = F.flatten(F.transform(grey, lambda x: F.array_repeat(x, 3)))
    made = sc.normalize_channels(_vectors(spark, sf), pixels, 8, 8)
    rows = made.select("vec_id", F.posexplode("channels").alias("channel", "values"))
    return rounded(rows.select("vec_id", "channel", F.posexplode("values").alias("pixel", "value")))


@query(
    "feature_vector",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(i AS INTEGER) AS position,
           [l_quantity, l_extendedprice, l_discount][i + 1] AS value
    FROM lineitem, (SELECT unnest(range(3)) AS i)
    """,
)
def feature_vector(spark, sf):
    made = sc.feature_vector(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return made.select(*keys, F.posexplode("features").alias("position", "value"))


def _windows(spark, sf):
    return fx.supervised_windows(events(spark, sf).select("user_id", "ts", "value"), "value", 6, 3, LOG)


@query(
    "naive_forecast",
    """
    WITH s AS (SELECT user_id, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n, value,
                      lead(value, 1) OVER w AS y1, lead(value, 2) OVER w AS y2, lead(value, 3) OVER w AS y3
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
         e AS (SELECT unnest([y1, y2, y3]) - value AS err FROM s WHERE i >= 6 AND i + 3 <= n)
    SELECT round(sqrt(avg(err * err)), 6) AS rmse, round(avg(abs(err)), 6) AS mae, round(avg(err * err), 6) AS mse FROM e
    """,
)
def naive_forecast(spark, sf):
    made = md.naive_forecast(_windows(spark, sf), 3)
    return rounded(ev.regression_metrics(made, "targets", "forecast"))


@query(
    "seasonal_forecast",
    """
    WITH s AS (SELECT user_id, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n,
                      lag(value, 3) OVER w AS p1, lag(value, 2) OVER w AS p2, lag(value, 1) OVER w AS p3, value AS p4,
                      lead(value, 1) OVER w AS y1, lead(value, 2) OVER w AS y2, lead(value, 3) OVER w AS y3
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
         e AS (SELECT unnest([y1 - p1, y2 - p2, y3 - p3]) AS err FROM s WHERE i >= 6 AND i + 3 <= n)
    SELECT round(sqrt(avg(err * err)), 6) AS rmse, round(avg(abs(err)), 6) AS mae, round(avg(err * err), 6) AS mse FROM e
    """,
)
def seasonal_forecast(spark, sf):
    made = md.seasonal_forecast(_windows(spark, sf), 4, 3)
    return rounded(ev.regression_metrics(made, "targets", "forecast"))


@query("lr_forecast")
def lr_forecast(spark, sf):
    """Fit on the earlier windows, report the error on the last fifth."""
    split = temporal_split(written(_windows(spark, sf), "windows"), 0.2, contract=LOG)
    model = md.LinearForecaster.fit(split.where("split = 'train'"), 3)
    return ev.regression_metrics(model.transform(split.where("split = 'test'")), "targets", "forecast")


@query(
    "one_lag_forecast",
    """
    WITH s AS (SELECT value AS x, lead(value) OVER (PARTITION BY user_id ORDER BY ts) AS y FROM events),
         p AS (SELECT x, y FROM s WHERE y IS NOT NULL),
         m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM p),
         e AS (SELECT y - (slope * x + intercept) AS err FROM p, m)
    SELECT round(sqrt(avg(err * err)), 6) AS rmse, round(avg(abs(err)), 6) AS mae, round(avg(err * err), 6) AS mse,
           (SELECT round(slope, 6) FROM m) AS slope, (SELECT round(intercept, 6) FROM m) AS intercept FROM e
    """,
)
def one_lag_forecast(spark, sf):
    """The linear forecaster with one reading back and one ahead: a regression line that SQL can fit too."""
    log = events(spark, sf).select("user_id", "ts", "value")
    windows = written(fx.supervised_windows(log, "value", 1, 1, LOG), "windows")
    forecaster = md.LinearForecaster.fit(windows, 1)
    line = forecaster.models[0]
    made = ev.regression_metrics(forecaster.transform(windows), "targets", "forecast")
    return rounded(made.withColumns({
        "slope": F.lit(float(line.coefficients[0])), "intercept": F.lit(float(line.intercept)),
    }))


FEATURES = ["value_roll_mean", "value_roll_std", "value_lag_1", "value"]


def _training(spark, sf):
    """Rolling features of every event, label "is an error", split by time.

    Training makes many passes, so the features are written once.
    """
    made = fx.build_features(
        labelled(spark, sf).select("event_id", "user_id", "ts", "value", "label"),
        [
            fx.Feature("value_roll_mean", "value", "mean", 6),
            fx.Feature("value_roll_std", "value", "std", 6),
            fx.Feature("value_lag_1", "value", "lag", 1),
        ],
        LOG,
    )
    return temporal_split(written(made, "training"), 0.2, contract=LOG)


def _tree_model(train):
    light = md.estimator("trees", features=FEATURES, label="label", params=md.LIGHT_TREE_PARAMS)
    return md.fit(train, light, FEATURES, "label")


@query("gbt_score")
def gbt_score(spark, sf):
    """Boosted trees on the earlier rows, all classification metrics on the last fifth."""
    data = _training(spark, sf)
    model = _tree_model(data.where("split = 'train'"))
    return md.holdout_report(model, data.where("split = 'test'"), "label")


STUMP = """
  WITH l AS (SELECT event_id, user_id % 8 AS x, CAST(event_type = 'error' AS INTEGER) AS label FROM events),
       c AS (SELECT cut, count(*) AS n, count(*) FILTER (WHERE x <= cut) AS n0, sum(label) FILTER (WHERE x <= cut) AS p0,
                    sum(label) AS p FROM l, (SELECT unnest(range(7)) AS cut) GROUP BY cut),
       g AS (SELECT *, p0 / n0 AS left_rate, (p - p0) / (n - n0) AS right_rate,
                    n0 * (p0 / n0) ** 2 + (n - n0) * ((p - p0) / (n - n0)) ** 2 AS gain FROM c),
       b AS (SELECT * FROM g ORDER BY gain DESC LIMIT 1),
       s AS (SELECT event_id, label, 1 / (1 + exp(-2 * (2 * CASE WHEN x <= cut THEN left_rate ELSE right_rate END - 1))) AS score
             FROM l, b)
"""


def _stump(spark, sf):
    """One tree of one split over a column of eight values: a model that SQL can fit by trying every split."""
    rows = labelled(spark, sf).select("event_id", "label", (F.col("user_id") % 8).cast("double").alias("x"))
    tree = {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0}
    return rows, md.fit(rows, md.estimator("trees", features=["x"], label="label", params=tree), ["x"], "label")


@query("stump_probability", STUMP + "SELECT event_id, round(score, 6) AS score FROM s")
def stump_probability(spark, sf):
    rows, model = _stump(spark, sf)
    return rounded(sc.positive_probability(model.transform(rows)).select("event_id", "score"))


@query(
    "stump_batches",
    STUMP
    + """
    , r AS (SELECT event_id, score, CAST(floor(CAST('0x' || substr(md5(event_id || '|7'), 1, 8) AS BIGINT)
                   / 4294967296.0::DOUBLE * 20) AS INTEGER) AS request FROM s)
    SELECT request, CAST(row_number() OVER (PARTITION BY request ORDER BY event_id) - 1 AS INTEGER) AS position, event_id,
           round(score, 6) AS failure_probability, score >= 0.5 AS will_fail FROM r
    """,
)
def stump_batches(spark, sf):
    """Batch scoring whose answers SQL can check: twenty requests, answered in the order asked."""
    rows, model = _stump(spark, sf)
    asked = rows.groupBy(hash_bucket(["event_id"], 7, 20).alias("request")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "x"))).alias("readings"))
    scored = sc.score_readings(model, sc.explode_requests(asked, "request"), ["request", "position", "event_id"])
    answers = sc.gather_responses(scored, "request", "event_id").select("request", F.posexplode("predictions").alias("position", "p"))
    return rounded(answers.select("request", "position", "p.*"))


@query(
    "logistic_rates",
    """
    SELECT event_id, round(avg(CAST(event_type = 'error' AS INTEGER)) OVER (PARTITION BY value > 20), 3) AS score FROM events
    """,
)
def logistic_rates(spark, sf):
    """Logistic regression on one yes-or-no column: its probabilities are the rates of the two groups."""
    rows = labelled(spark, sf).select("event_id", "label", (F.col("value") > 20).cast("double").alias("high"))
    model = md.fit(rows, md.estimator("logistic", features=["high"], label="label", params={"tol": 1e-9}), ["high"], "label")
    return rounded(sc.positive_probability(model.transform(rows)).select("event_id", "score"), 3)


@query(
    "search_folds",
    """
    WITH s AS (SELECT event_id, value AS x, lead(value) OVER (PARTITION BY user_id ORDER BY ts) AS y FROM events),
         p AS (SELECT x, y, CAST(floor(CAST('0x' || substr(md5(event_id || '|42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * 5)
                                 AS INTEGER) AS fold FROM s WHERE y IS NOT NULL),
         m AS (SELECT f, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, sum(x * y) / sum(x * x) AS through
               FROM p, (SELECT unnest(range(5)) AS f) WHERE fold <> f GROUP BY f),
         e AS (SELECT f, sqrt(avg((y - slope * x - intercept) ** 2)) AS with_line, sqrt(avg((y - through * x) ** 2)) AS without
               FROM p JOIN m ON fold = f GROUP BY f)
    SELECT 0::BIGINT AS number, round(avg(with_line), 6) AS value FROM e UNION ALL SELECT 1, round(avg(without), 6) FROM e
    """,
)
def search_folds(spark, sf):
    """A search whose trials SQL can score: a regression line with and without its intercept, over five hashed folds."""
    log = events(spark, sf).select("event_id", "user_id", "ts", "value")
    following = F.lead("value").over(Window.partitionBy("user_id").orderBy("ts"))
    pairs = log.withColumn("y", following).where("y is not null")
    data = written(kfold(pairs, ["event_id"], 5).select("fold", "y", F.col("value").alias("x")), "pairs")
    line = Pipeline(stages=[
        VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y", solver="normal")])
    settings = [{"fitIntercept": True}, {"fitIntercept": False}]
    results, _ = md.search(data, line, settings, "y", metric="rmse", folds=5, fold_column="fold")
    return rounded(md.trial_table(spark, results).select("number", "value"))


@query(
    "window_tail_split",
    """
    WITH s AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i,
                      count(*) OVER (PARTITION BY user_id) AS n FROM events),
         w AS (SELECT user_id, ts FROM s WHERE i >= 6 AND i + 3 <= n)
    SELECT user_id, ts, CASE WHEN row_number() OVER (ORDER BY ts, user_id)
           <= count(*) OVER () - greatest(1, floor(count(*) OVER () * 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split
    FROM w
    """,
)
def window_tail_split(spark, sf):
    """The last fifth of the windows is for testing."""
    return temporal_split(written(_windows(spark, sf), "windows"), 0.2, contract=LOG).select("user_id", "ts", "split")


@query("logreg_score")
def logreg_score(spark, sf):
    """Ten-class logistic regression on the embeddings with a hash split."""
    df = _vectors(spark, sf).select("vec_id", F.col("label").cast("double").alias("label"),
                                    *[F.get("embedding", i).alias(f"x{i}") for i in range(64)])
    data = hash_split(df, ["vec_id"], 0.2)
    features = [f"x{i}" for i in range(64)]
    pipeline = md.estimator("logistic", features=features, label="label")
    model = md.fit(data.where("split = 'train'"), pipeline, features, "label")
    return ev.macro_f1(model.transform(data.where("split = 'test'")), "label", "prediction")


@query("positive_proba")
def positive_proba(spark, sf):
    data = _training(spark, sf)
    scored = sc.positive_probability(_tree_model(data.where("split = 'train'")).transform(data))
    return scored.select("event_id", "score")


@query("batch_score")
def batch_score(spark, sf):
    """Requests of about 500 readings, answered in the order asked.

    Readings are dealt to requests by a hash, so no request grows with one user's share of the data.
    """
    data = _training(spark, sf)
    model = _tree_model(data.where("split = 'train'"))
    test = data.where("split = 'test'")
    request = hash_bucket(["event_id"], 7, max(1, test.count() // 500)).alias("request")
    reading = F.struct("event_id", "user_id", *FEATURES)
    batches = test.groupBy(request).agg(F.array_sort(F.collect_list(reading)).alias("readings"))
    rows = sc.explode_requests(batches, "request")
    scored = sc.score_readings(model, rows, ["request", "position", "event_id"])
    answers = sc.gather_responses(scored, "request", "event_id")
    return answers.select("request", F.posexplode("predictions").alias("position", "p")).select(
        "request", "position", "p.*"
    )


@query("search_space_sample")
def search_space_sample(spark, sf):
    """Sampled settings of the logistic baseline, scored by cross validation on hashed folds."""
    space = {
        "regParam": {"type": "float", "low": 0.001, "high": 1.0, "log": True},
        "maxIter": {"type": "int", "low": 50, "high": 200, "step": 50},
        "elasticNetParam": {"type": "categorical", "choices": [0.0, 0.5]},
    }
    data = kfold(_training(spark, sf), ["event_id"], md.FOLDS)
    pipeline = md.estimator("logistic", features=FEATURES, label="label")
    settings = md.sample_space(space, 30)
    results, _ = md.search(data, pipeline, settings, "label", folds=md.FOLDS, fold_column="fold", parallelism=8)
    return md.trial_table(spark, results)
