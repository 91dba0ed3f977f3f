from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import runs as rn
from tidemark.operators import splits as sp


def test_version_resolution(spark):
    rows = [("a", "9", None, None), ("a", "10", None, None), ("b", "1", "champion", None), ("b", "7", None, "Production"),
            ("c", "2", None, "Production"), ("c", "3", None, "Production"), ("c", "4", None, None)]
    df = spark.createDataFrame(rows, "name string, version string, alias string, stage string")
    got = {r["name"]: (r["version"], r["uri"]) for r in rn.resolve_version(df, stage="Production").collect()}
    assert got == {"a": ("10", "models:/a/10"), "b": ("1", "models:/b@champion"), "c": ("3", "models:/c/Production")}
    assert rn.resolve_version(df.where("name = 'none'")).isEmpty()


def test_canary(spark):
    probes = spark.createDataFrame([("a", "ok")] * 3 + [("a", "error"), ("b", "degraded"), ("d", "ok")], "target string, status string")
    targets = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "target string")
    got = {r["target"]: (r["success_rate"], r["decision"]) for r in rn.canary_decision(probes, targets).collect()}
    assert got == {"a": (0.75, "rollback"), "b": (0.0, "rollback"), "c": (0.0, "rollback"), "d": (1.0, "promote")}


def test_trials(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.7), (3, 0.9)], "number int, value double")
    assert [r["number"] for r in rn.top_trials(df, 2).collect()] == [1, 3]
    assert [r["best_value"] for r in rn.best_so_far(df).orderBy("number").collect()] == [0.5, 0.9, 0.9, 0.9]
    assert [r["best_value"] for r in rn.best_so_far(df, maximize=False).orderBy("number").collect()] == [0.5] * 4


def test_pruning_respects_the_warmup(spark):
    rows = [(t, s, float(t)) for t in range(5) for s in range(4)]
    df = spark.createDataFrame(rows, "trial int, step int, value double")
    got = {r["trial"]: r["pruned_at"] for r in rn.median_prune(df, warmup=1).collect()}
    assert got == {0: 1, 1: 1, 2: None, 3: None, 4: None}


def test_pareto_front_against_brute_force(spark, sliced):
    rows = [((i * 37) % 50, (i * 61) % 43) for i in range(200)]
    front = {(g, c) for g, c in rows if not any((a >= g and b < c) or (a > g and b <= c) for a, b in rows)}
    df = spark.createDataFrame(rows, "g int, c int")
    assert {tuple(r) for r in rn.pareto_front(df, "g", "c").collect()} == front


def test_names_and_eligibility(spark):
    runs = spark.createDataFrame([(1, "tabular"), (2, "vision")], "run_id int, model string")
    gates = spark.createDataFrame([(1, True), (2, False)], "run_id int, passed boolean")
    assert [r["name"] for r in rn.eligible_models(runs, gates, "factory").collect()] == ["factory-tabular"]


def test_param_importance_finds_the_cause(spark):
    df = spark.createDataFrame([(i % 4, i % 3, float((i % 4) * 10 + (i % 3))) for i in range(120)], "a int, b int, value double")
    got = {r["param"]: r["importance"] for r in rn.param_importance(df, {"a": F.col("a"), "b": F.col("b")}).collect()}
    assert got["a"] > 0.95 and abs(sum(got.values()) - 1) < 1e-9


def test_run_maps(spark):
    df = spark.createDataFrame([(1, 0, {"lr": "0.1"}, {"f1": 0.8})], "run_id int, parent_id int, params map<string,string>, metrics map<string,double>")
    assert rn.run_columns(df, ["lr", "absent"], ["f1"]).first().asDict() == {"run_id": 1, "parent_id": 0, "lr": "0.1", "absent": None, "f1": 0.8}
    assert {(r["kind"], r["name"], r["value"]) for r in rn.run_entries(df).collect()} == {("params", "lr", "0.1"), ("metrics", "f1", "0.8")}


def test_splits_are_stable_and_exact(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    split = sp.stratified_split(df, "y", ["id"], 0.3)
    got = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 270, (0, "train"): 630, (1, "test"): 30, (1, "train"): 70}
    part = sp.hash_split(df.where("id < 500"), ["id"], 0.3)
    assert part.exceptAll(sp.hash_split(df, ["id"], 0.3)).isEmpty()
    groups = sp.hash_split(df, ["y"], 0.5).groupBy("y").agg(F.count_distinct("split").alias("n"))
    assert all(r["n"] == 1 for r in groups.collect())
    weights = {r["y"]: r["weight"] for r in sp.class_weights(df, "y").collect()}
    assert weights == {0: 1000 / 1800, 1: 1000 / 200}
    assert set(r["fold"] for r in sp.kfold(df, ["id"]).select("fold").distinct().collect()) == set(range(5))
    assert sp.temporal_split(df.limit(0), 0.2, contract=Contract(("y",), "id")).isEmpty()
    assert sp.with_class_weights(df, "y").count() == 1000 and sp.resample(df, "y", ["id"], {1: 50}).count() == 50
