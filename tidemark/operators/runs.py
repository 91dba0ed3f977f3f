"""Analytics over runs, trials, model versions and rollouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import equal_width_bin, hash_share, log10_bin, ratio, two_proportion_z
from tidemark.plans.distribution import exact_quantiles
from tidemark.plans.joins import join_small
from tidemark.plans.ordered import running

# Registry alias and canary threshold.
CHAMPION = "champion"
CANARY_THRESHOLD = 0.95


def run_entries(runs: DataFrame, maps: Sequence[str] = ("params", "metrics"), key: str = "run_id") -> DataFrame:
    """Params and metrics as rows: run, kind, name, value (as text)."""
    parts = []
    for m in maps:
        rows = runs.select(key, F.lit(m).alias("kind"), F.explode(m).alias("name", "value"))
        parts.append(rows.withColumn("value", F.col("value").cast("string")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_columns(runs: DataFrame, params: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Named params and metrics as columns; the maps are read in place, so no shuffle."""
    named = [F.try_element_at("params", F.lit(p)).alias(p) for p in params]
    named += [F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics]
    keep = [c for c in runs.columns if c not in ("params", "metrics")]
    return runs.select(*keep, *named)


def with_children(parents: DataFrame, children: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """Parents with their number of children and the best child by the metric, the smallest run_id among equals.

    Children without the metric (NULL or NaN) count but are never best. Children are reduced to one row per parent
    before the join.
    """
    value = F.nanvl(F.try_element_at("metrics", F.lit(metric)).cast("double"), F.lit(None).cast("double"))
    rank = F.when(value.isNotNull(), F.struct((-value if maximize else value).alias("__rank"), F.col("run_id").alias("run_id")))
    top = children.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_children"), F.min(rank).alias("__top"))
    found = F.col("__top.__rank")
    top = top.select(
        "parent_id", "n_children", (-found if maximize else found).alias(f"best_{metric}"),
        F.col("__top.run_id").alias("best_run_id"),
    )
    joined = parents.join(top.withColumnRenamed("parent_id", "run_id"), "run_id", "left")
    return joined.withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def top_trials(trials: DataFrame, k: int = 5, maximize: bool = True) -> DataFrame:
    """The k best trials; equal values go to the earlier trial. A top-k report, kept per task before merging."""
    order = F.desc_nulls_last("value") if maximize else F.asc_nulls_last("value")
    return trials.orderBy(order, F.asc("number")).limit(k)


def best_so_far(trials: DataFrame, maximize: bool = True) -> DataFrame:
    """Best value over all trials up to each one."""
    kind = "max" if maximize else "min"
    return running(trials, [], ["number"], {"best_value": (kind, F.col("value"))})


def param_importance(trials: DataFrame, params: dict[str, Column], value: str = "value") -> DataFrame:
    """Share of the variance of the value between the groups of each param, and scaled to sum to 1.

    Params are given as grouping expressions (the param itself or a bin of it).
    """
    named = F.create_map(*[x for n, c in params.items() for x in (F.lit(n), c.cast("string"))])
    rows = trials.where(F.col(value).isNotNull()).select(F.explode(named).alias("param", "__bin"), F.col(value).cast("double").alias("__v"))
    groups = rows.groupBy("param", "__bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("__v").alias("m"), F.var_pop("__v").alias("var")
    )
    n, m = F.col("n"), F.col("m")
    grand = groups.groupBy("param").agg((F.sum(n * m) / F.sum("n")).alias("grand"))
    # distances from the grand mean, not a difference of squares, which would cancel
    sums = groups.join(grand, "param").groupBy("param").agg(
        F.sum(n * (m - F.col("grand")) * (m - F.col("grand"))).alias("between"),
        F.sum(n * F.col("var")).alias("within"),
    )
    shares = sums.select("param", ratio(F.col("between"), F.col("between") + F.col("within")).alias("explained"))
    total = shares.agg(F.sum("explained")).scalar()
    return shares.withColumn("importance", ratio(F.col("explained"), total))


def param_response(
    trials: DataFrame, param: str, low: float, high: float, bins: int, log: bool = False, maximize: bool = True,
    value: str = "value",
) -> DataFrame:
    """Mean and best value per param bin, and whether the best bin lies on the edge of the range."""
    x = F.col(param).cast("double")
    place = log10_bin(x, low, high, bins) if log else equal_width_bin(x, F.lit(low), F.lit(high), bins)
    best = F.max if maximize else F.min
    table = trials.where(x.between(low, high)).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"), best(value).alias("best_value")
    )
    pick = F.max_by if maximize else F.min_by
    winner = table.agg(pick("bin", F.struct(F.col("best_value"), F.col("bin")))).scalar()
    return table.withColumn("optimum_on_edge", (winner == 0) | (winner == bins - 1))


def median_prune(steps: DataFrame, warmup: int = 5, maximize: bool = True) -> DataFrame:
    """Per trial the first step after the warm-up whose value is worse than the median of that step.

    ``steps`` holds (trial, step, value). Trials that are never worse have NULL.
    """
    medians = exact_quantiles(steps, ["value"], [0.5], ["step"]).select("step", F.col("q0").alias("median"))
    judged = join_small(steps, medians, ["step"])
    worse = F.col("value") < F.col("median") if maximize else F.col("value") > F.col("median")
    stop = F.when(worse & (F.col("step") >= warmup), F.col("step"))
    return judged.groupBy("trial").agg(F.count(F.lit(1)).alias("n_steps"), F.min(stop).alias("pruned_at"))


def pareto_front(df: DataFrame, gain: str, cost: str) -> DataFrame:
    """Rows no other row beats: none has more gain at no more cost, or less cost at no less gain.

    Gains are reduced to their lowest cost and walked from the highest down with a running minimum
    of the cost; the front is where that minimum first reaches each of its values.
    """
    points = df.where(F.col(gain).isNotNull() & F.col(cost).isNotNull())
    points = points.select((-F.col(gain)).alias("__minus_gain"), F.col(cost).alias("__cost"))
    best = points.groupBy("__minus_gain").agg(F.min("__cost").alias("__cost"))
    low = {"__low": ("min", F.col("__cost"))}
    walked = running(best, [], ["__minus_gain"], low, sizing=points, raw={"__low": F.col("__cost")})
    front = walked.groupBy("__low").agg(F.min("__minus_gain").alias("__minus_gain"))
    points = front.select((-F.col("__minus_gain")).alias(gain), F.col("__low").alias(cost))
    return df.join(points, [gain, cost], "left_semi")


def resolve_version(versions: DataFrame, alias: str = CHAMPION, stage: str | None = None) -> DataFrame:
    """Per model the version to serve: the alias, else the highest version of the stage, else the highest.

    ``versions`` holds (name, version, alias, stage). Versions compare as whole numbers.
    """
    number = F.col("version").try_cast("long")
    in_stage = F.coalesce(F.col("stage") == F.lit(stage), F.lit(False)) if stage else F.lit(False)
    level = F.when(F.col("alias") == alias, 2).when(in_stage, 1).otherwise(0)
    picked = versions.where(number.isNotNull()).groupBy("name").agg(
        F.max(F.struct(level.alias("level"), number.alias("number"))).alias("__p")
    )
    uri = (
        F.when(F.col("__p.level") == 2, F.concat(F.lit("models:/"), "name", F.lit(f"@{alias}")))
        .when(F.col("__p.level") == 1, F.concat(F.lit("models:/"), "name", F.lit(f"/{stage}")))
        .otherwise(F.concat(F.lit("models:/"), "name", F.lit("/"), F.col("__p.number").cast("string")))
    )
    how = F.when(F.col("__p.level") == 2, "alias").when(F.col("__p.level") == 1, "stage").otherwise("latest")
    return picked.select(
        "name", F.col("__p.number").cast("string").alias("version"), how.alias("resolved_by"), uri.alias("uri")
    )


def registered_name(project: str, model: Column) -> Column:
    """The one naming rule of the registry."""
    return F.concat_ws("-", F.lit(project), model)


def eligible_models(runs: DataFrame, gates: DataFrame, project: str) -> DataFrame:
    """Runs that may be registered, with their registry name: those whose gate passed."""
    passed = gates.where(F.col("passed")).select("run_id")
    return runs.join(passed, "run_id", "left_semi").withColumn("name", registered_name(project, F.col("model")))


def canary_decision(
    probes: DataFrame, targets: DataFrame, target: str = "target", threshold: float = CANARY_THRESHOLD
) -> DataFrame:
    """Success rate of the probes per target and the decision. Only "ok" counts; no answers means 0."""
    rates = probes.groupBy(target).agg(
        F.count(F.lit(1)).alias("n_probes"), F.avg((F.coalesce(F.col("status"), F.lit("")) == "ok").cast("double")).alias("rate")
    )
    joined = targets.select(target).distinct().join(rates, target, "left")
    rate = F.coalesce(F.col("rate"), F.lit(0.0))
    return joined.select(
        target,
        F.coalesce("n_probes", F.lit(0)).alias("n_probes"),
        rate.alias("success_rate"),
        F.when(rate >= threshold, "promote").otherwise("rollback").alias("decision"),
    )


def ab_assign(df: DataFrame, key: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Send a fixed share of keys to the new version; a key always sees the same one."""
    return df.withColumn("arm", F.when(hash_share(key, seed) < share, "new").otherwise("current"))


def ab_compare(df: DataFrame, outcome: Column, by: Sequence[str] = ()) -> DataFrame:
    """Outcome rate of both arms and the z statistic of their difference."""
    new, hit = F.col("arm") == "new", F.coalesce(outcome, F.lit(False))
    counts = df.groupBy(*by).agg(
        F.count_if(new).alias("n_new"),
        F.count_if(~new).alias("n_current"),
        F.count_if(new & hit).alias("hits_new"),
        F.count_if(~new & hit).alias("hits_current"),
    )
    x1, n1, x2, n2 = (F.col(c) for c in ("hits_new", "n_new", "hits_current", "n_current"))
    return counts.withColumns(
        {"rate_new": ratio(x1, n1), "rate_current": ratio(x2, n2), "z": two_proportion_z(x1, n1, x2, n2)}
    )
