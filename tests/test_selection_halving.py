"""Selection by counting, exact samples, pruning of trials, functional variance, sketches."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import halving as hv
from tidemark.operators import importance as im
from tidemark.operators import sketches as sk
from tidemark.operators import splits as sp
from tidemark.plans.selection import GROUP, grouped_cuts, upto_cuts


@pytest.mark.parametrize("limit", [7, 1_000_000])
def test_kth_row_of_each_group(spark, limit):
    rng = random.Random(limit)
    rows = [("hot", rng.choice([-5.0, 1.5, 1.5, 1e9, rng.gauss(0, 1), None]), i) for i in range(400)]
    rows += [(rng.choice(["a", None]), float(rng.randrange(6)), i) for i in range(400, 460)] + [("one", 3.0, 999)]
    df = spark.createDataFrame(rows, "g string, x double, id int")
    spark.conf.set("spark.tidemark.rowsPerTask", str(limit))
    try:
        groups = defaultdict(list)
        for g, x, i in rows:
            groups[g].append((x is not None, x or 0.0, i))
        for share in (0.1, 0.5, 1.0):
            wanted = df.groupBy(F.struct("g").alias(GROUP)).agg(F.ceil(F.count("*") * share).alias("k"))
            cuts = grouped_cuts(df, ["g"], ["x", "id"], wanted)
            got = Counter(r.g for r in upto_cuts(df, ["g"], ["x", "id"], cuts).where("__chosen").collect())
            assert got == {g: int(np.ceil(len(v) * share)) for g, v in groups.items()}
            for r in cuts.collect():
                key = sorted(groups[r[GROUP].g])[int(np.ceil(len(groups[r[GROUP].g]) * share)) - 1]
                assert (r["__cut"].x, r["__cut"].id) == (key[1] if key[0] else None, key[2])
    finally:
        spark.conf.unset("spark.tidemark.rowsPerTask")


def test_positions_outside_a_group_choose_nothing(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2)], "g string, x double, id int")
    wanted = spark.createDataFrame([("a", 0)], "g string, k long").select(F.struct("g").alias(GROUP), "k")
    assert grouped_cuts(df, ["g"], ["x", "id"], wanted).count() == 0
    assert upto_cuts(df, ["g"], ["x", "id"], grouped_cuts(df, ["g"], ["x", "id"], wanted)).where("__chosen").count() == 0


def test_resample_counts_and_nesting(spark):
    df = spark.createDataFrame([(i, ["a", "b", None][i % 3], i % 4) for i in range(90)], "id int, label string, copy int").drop("copy")
    got = sp.resample(df, "label", ["id"], {"a": 75, "b": 7, None: 30}).collect()
    assert Counter(r.label for r in got) == {"a": 75, "b": 7, None: 30}
    assert {r.copy for r in got if r.label == "a"} == {1, 2, 3} and max(Counter(r.id for r in got if r.label == "a").values()) == 3
    fewer = {r.id for r in sp.resample(df, "label", ["id"], {"b": 4}).collect()}
    assert fewer < {r.id for r in got if r.label == "b"}
    assert Counter(r.label for r in sp.balanced(df.where("label = 'a' or id < 30"), "label", ["id"], over=True).collect()) == {"a": 30, "b": 30, None: 30}
    assert sp.resample(df.where("false"), "label", ["id"], {"a": 3}).count() == 0
    plan = sp.resample(df, "label", ["id"], {"a": 75})._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def log_of(seed, trials=80, steps=9):
    rng = random.Random(seed)
    made = []
    for t in range(trials):
        for s in range(1, rng.choice([2, steps, steps, steps]) + 1):
            made.append((t, s, rng.choice([None, float(rng.randrange(20)), float(rng.randrange(20))]) if s in (1, 3) else float(t % 7), rng.random()))
    return made


def frame(spark, made):
    return spark.createDataFrame(made, "trial int, step int, value double, at double")


def halved(made, last, eta, first=1, sign=1):
    stopped = {}
    for step in hv.rungs(first, last, eta):
        there = sorted((-sign * v, t) for t, s, v, _ in made if s == step and v is not None and t not in stopped)
        for _, t in there[max(1, len(there) // eta):]:
            stopped[t] = step
    return stopped


def outcome(made, stopped):
    n = Counter(t for t, *_ in made)
    run = Counter(t for t, s, *_ in made if t not in stopped or s <= stopped[t])
    return {t: (n[t], stopped.get(t), run[t]) for t in n}


@pytest.mark.parametrize("maximize", [True, False])
def test_successive_halving(spark, maximize):
    made = log_of(1)
    got = hv.successive_halving(frame(spark, made), 9, 3, maximize=maximize).collect()
    assert {r.trial: (r.n_steps, r.stopped_at, r.n_run) for r in got} == outcome(made, halved(made, 9, 3, sign=1 if maximize else -1))


def test_asha_decides_report_by_report(spark):
    made = log_of(2)
    stopped = {}
    for step in hv.rungs(1, 9, 3):
        seen = []
        for at, t, v in sorted((at, t, v) for t, s, v, at in made if s == step and v is not None and t not in dict(stopped)):
            seen.append(v)
            if v < sorted(seen, reverse=True)[max(1, len(seen) // 3) - 1]:
                stopped[t] = step
    got = hv.asha(frame(spark, made), "at", 9, 3).collect()
    assert {r.trial: (r.n_steps, r.stopped_at, r.n_run) for r in got} == outcome(made, stopped)


def test_hyperband_is_halving_in_each_bracket(spark):
    made = log_of(3, 150)
    assert [(s, first) for s, first, _ in hv.brackets(9, 3)] == [(0, 9), (1, 3), (2, 1)]
    got = hv.hyperband(frame(spark, made), 9, 3).collect()
    of = {r.trial: r.bracket for r in got}
    assert set(of.values()) == {0, 1, 2}
    for s, first, _ in hv.brackets(9, 3):
        mine = [r for r in made if of[r[0]] == s]
        assert {r.trial: (r.n_steps, r.stopped_at, r.n_run) for r in got if r.bracket == s} == outcome(mine, halved(mine, 9, 3, first))
    saved = {(r.bracket, r.stopped_at): r.n_run for r in hv.rung_table(hv.hyperband(frame(spark, made), 9, 3), ["bracket"]).collect()}
    assert sum(saved.values()) == sum(r.n_run for r in got)


def test_trials_without_steps(spark):
    none = frame(spark, []).where("false")
    assert hv.successive_halving(none, 9).count() == 0 and hv.asha(none, "at", 9).count() == 0


def test_functional_variance_matches_integration():
    rng = np.random.default_rng(1)
    boxes = [(np.zeros(3), np.array([2.0, 1.0, 5.0]))]
    for _ in range(12):  # cut random boxes at random places
        a, b = boxes.pop(rng.integers(len(boxes)))
        d = rng.integers(3)
        cut = round(rng.uniform(a[d], b[d]), 1)
        left, right = b.copy(), a.copy()
        left[d] = right[d] = cut
        boxes += [(a, left), (right, b)]
    low, high = np.array([a for a, _ in boxes]), np.array([b for _, b in boxes])
    value = rng.normal(size=len(boxes))
    total, parts = im.functional_variance(low, high, value)
    n = (20, 10, 50)
    mids = np.meshgrid(*[(np.arange(k) + 0.5) * w / k for k, w in zip(n, (2, 1, 5))], indexing="ij")
    f = np.zeros(n)
    for a, b, v in zip(low, high, value):
        f += v * np.all([(a[d] < mids[d]) & (mids[d] < b[d]) for d in range(3)], axis=0)
    g = f - f.mean()
    mains = [g.mean(axis=tuple(e for e in range(3) if e != d)) for d in range(3)]
    assert total == pytest.approx((g**2).mean())
    for d in range(3):
        assert parts[(d,)] == pytest.approx((mains[d] ** 2).mean())
    for d, e in ((0, 1), (0, 2), (1, 2)):
        both = g.mean(axis=3 - d - e) - mains[d][:, None] - mains[e][None, :]
        assert parts[(d, e)] == pytest.approx((both**2).mean())


def test_param_variance_finds_the_interaction(spark):
    rng = random.Random(3)
    made = [(rng.random(), rng.random(), 5.0) for _ in range(3000)]
    df = spark.createDataFrame([(a, b, c, float((a > 0.4) + 4 * (a > 0.4) * (b > 0.5))) for a, b, c in made] + [(None, 0.1, 5.0, 1.0)], "a double, b double, c double, value double")
    got = {r.params: r.share for r in im.param_variance(df, ["a", "b", "c"], depth=3).collect()}
    # by hand: a is 1 above 0.4 and 3 on average, b adds 4 there
    p, d = 0.6, 4.0
    main_a, main_b, pair = p * (1 - p) * 9, 0.25 * (d * p) ** 2, 0.25 * d**2 * p * (1 - p)
    for name, want in (("a", main_a), ("b", main_b), ("a,b", pair)):
        assert got[name] == pytest.approx(want / (main_a + main_b + pair), abs=0.02)
    assert set(got) == {"a", "b", "a,b"}
    assert im.param_variance(df.where("false"), ["a", "b"]).count() == 0


def test_sketches_stay_within_their_rank_error(spark):
    df = spark.range(200_000).select(
        (F.randn(3) * F.when(F.col("id") % 100 == 0, 1e6).otherwise(1)).alias("x"), (F.col("id") % 13).alias("g"),
        F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.floor(F.sqrt("id"))).alias("y")).repartition(7)
    k = 400
    whole = sk.summaries(df, ["x", "y"], k=k)
    merged = sk.merged(sk.summaries(df, ["x", "y"], ["g"], k), k=k)
    values = {c: np.array([r[0] for r in df.select(c).where(f"not isnan({c})").collect()], float) for c in "xy"}
    for found in (whole, merged):
        for r in sk.described(found, (0.01, 0.25, 0.5, 0.75, 0.99)).collect():
            v = np.sort(values[r.feature])
            assert r["count"] == len(v) and r["min"] == v[0] and r["max"] == v[-1]
            assert r["mean"] == pytest.approx(v.mean()) and r["std"] == pytest.approx(v.std(ddof=1))
            for p, name in ((0.01, "p1"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.99, "p99")):
                low, high = (np.searchsorted(v, r[name], side) / len(v) for side in ("left", "right"))
                assert low - 2 * sk.rank_error(k) <= p <= high + 2 * sk.rank_error(k)


def test_sketches_do_not_group_by_value(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (float("nan"), "b")], "x double, g string")
    plan = sk.summaries(df, ["x"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(g" in plan
    got = {r.g: r for r in sk.described(sk.summaries(df, ["x"], ["g"])).collect()}
    assert got["a"]["count"] == 1 and got["a"].p50 == 1.0 and got["b"]["count"] == 0 and got["b"].p50 is None
    assert sk.described(sk.merged(sk.summaries(df, ["x"], ["g"]))).first()["count"] == 1
    assert sk.drift_of_summaries(sk.summaries(df, ["x"]), sk.summaries(df.where("g = 'b'"), ["x"])).count() == 0


def test_sketch_drift_is_near_the_exact_distance(spark):
    from tidemark.operators import drift as dr

    ref = spark.range(20_000).select(F.randn(1).alias("x"))
    cur = spark.range(15_000).select((F.randn(2) + 0.2).alias("x"))
    exact = dr.drift_report(dr.stack_sides(ref, cur, ["x"]), ["x"]).first()
    found = sk.drift_of_summaries(sk.summaries(ref, ["x"]), sk.summaries(cur, ["x"])).first()
    assert found.statistic == pytest.approx(exact.statistic, abs=2 * sk.rank_error() + 0.002)
    assert found.psi == pytest.approx(exact.psi, abs=0.01) and found.drifted and exact.drifted
