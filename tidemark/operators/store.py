"""Feature store operators: point-in-time joins, latest values, freshness, coverage and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import Contract, FeatureService, FeatureView, resolve_features
from tidemark.functions.times import micros
from tidemark.plans.ordered import LARGE, SLICE, find_slices, same_row

_TIME, _SIDE, _ROW = "__time", "__side", "__row"


@dataclass(frozen=True)
class Source:
    """Feature rows to look up: table, keys, wanted columns, time to live.

    Result columns are ``prefix`` + feature, plus ``prefix`` + "feature_ts" when match times are kept.
    """

    df: DataFrame
    contract: Contract
    features: tuple[str, ...]
    ttl: timedelta | None = None
    prefix: str = ""


def _carry(rows: DataFrame, by: list[str], order: list[str], packs: list[str]) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({p: F.last(p, ignorenulls=True).over(window) for p in packs}).where(F.col(_SIDE) == 1)


def _slice_starts(sliced: DataFrame, by: list[str], packs: list[str]) -> DataFrame:
    """For every slice of a large entity, the last feature rows of all earlier slices."""
    ends = (
        sliced.where(F.col(LARGE))
        .groupBy(*by, SLICE)
        .agg(*[F.max_by(p, F.when(F.col(p).isNotNull(), F.col(_TIME))).alias(p) for p in packs])
    )
    earlier = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*by, SLICE, *[F.last(p, ignorenulls=True).over(earlier).alias(p) for p in packs])
    return starts.withColumns({_SIDE: F.lit(-1), _TIME: F.lit(None).cast("long")})


def asof_join(
    spine: DataFrame,
    sources: Sequence[Source],
    contract: Contract = Contract(),
    keep_feature_time: bool = False,
    direction: str = "backward",
) -> DataFrame:
    """Per spine row, the latest row of every source at or before its time; no match gives NULL.

    Spine and sources are stacked and the last feature row is carried down the time order: one
    shuffle for any number of sources and no pairing of rows. A match older than the ttl counts as
    none; a match exactly ttl old is kept. Feature rows of equal time are ordered by the tie columns
    of their source. ``direction="forward"`` looks at or after the spine time instead.

    An entity too large for one task is cut in time slices; copies of one (entity, time) are looked
    up once and joined back.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    sign = 1 if direction == "backward" else -1
    by = [f"__e{i}" for i in range(len(contract.entity))]
    packs = [f"__p{i}" for i in range(len(sources))]
    ties = [[f"__t{i}_{j}" for j in range(len(s.contract.tie))] for i, s in enumerate(sources)]

    def keyed(c: Contract) -> list[Column]:
        named = [F.col(e).alias(b) for e, b in zip(c.entity, by)]
        return [*named, (F.lit(sign) * micros(c.time)).alias(_TIME)]

    looked_up = spine.select(*keyed(contract), F.lit(1).alias(_SIDE), F.struct(*spine.columns).alias(_ROW))
    stacks = []
    for s, pack, tie in zip(sources, packs, ties):
        c = s.contract
        fields = F.struct(F.col(c.time).alias("feature_ts"), *[F.col(f) for f in s.features])
        with_key = s.df.dropna(subset=list(c.key))
        tied = [F.col(column).alias(name) for column, name in zip(c.tie, tie)]
        stacks.append(with_key.select(*keyed(c), F.lit(0).alias(_SIDE), fields.alias(pack), *tied))

    def stack(first: DataFrame, rest: Sequence[DataFrame]) -> DataFrame:
        for other in rest:
            first = first.unionByName(other, allowMissingColumns=True)
        return first

    if sign == -1:
        # the first of several rows at the next time, where the carried row would be the last
        stacks = [
            d.groupBy(*by, _TIME, _SIDE).agg(F.min_by(p, F.struct(*tie)).alias(p), *[F.min(t).alias(t) for t in tie])
            if tie else d
            for d, p, tie in zip(stacks, packs, ties)
        ]
    keys_only = [d.select(*by, _TIME) for d in (looked_up, *stacks)]
    slices = find_slices(keys_only[0], by, [_TIME], sizing=stack(keys_only[0], keys_only[1:]))
    if slices is None:
        order = [_TIME, _SIDE, *[t for tie in ties for t in tie]]
        found = _carry(stack(looked_up, stacks), by, order, packs)
    else:
        moments = looked_up.select(*by, _TIME).distinct().withColumn(_SIDE, F.lit(1))
        single = [
            d.groupBy(*by, _TIME, _SIDE).agg(F.max_by(p, F.struct(*tie) if tie else F.lit(0)).alias(p))
            for d, p, tie in zip(stacks, packs, ties)
        ]
        sliced = slices.assign(stack(moments, single))
        whole = sliced.drop(LARGE).unionByName(_slice_starts(sliced, by, packs))
        answers = _carry(whole, [*by, SLICE], [_TIME, _SIDE], packs).drop(SLICE, _SIDE)
        found = looked_up.join(answers, same_row(looked_up, answers, [*by, _TIME]), "left").select(_ROW, *packs)

    columns = [F.col(f"{_ROW}.{c}").alias(c) for c in spine.columns]
    for s, pack in zip(sources, packs):
        valid = F.col(f"{pack}.feature_ts").isNotNull()
        if s.ttl is not None:
            seen, now = F.col(f"{pack}.feature_ts"), F.col(f"{_ROW}.{contract.time}")
            ttl = F.lit(s.ttl)
            valid = (seen >= now - ttl) if sign == 1 else (seen <= now + ttl)
        if keep_feature_time:
            columns.append(F.when(valid, F.col(f"{pack}.feature_ts")).alias(f"{s.prefix}feature_ts"))
        columns += [F.when(valid, F.col(f"{pack}.{f}")).alias(f"{s.prefix}{f}") for f in s.features]
    return found.select(*columns)


def historical_features(
    spine: DataFrame,
    tables: Mapping[str, DataFrame],
    views: Sequence[FeatureView],
    features: Sequence[str] | None = None,
    service: FeatureService | None = None,
    contract: Contract = Contract(),
    keep_feature_time: bool = False,
) -> DataFrame:
    """Training rows for the named features. Names clash-free across views stay as they are."""
    chosen = resolve_features(views, features, service)
    known = {v.name: v for v in (*views, *(service.views if service else ()))}
    names = [f for wanted in chosen.values() for f in wanted]
    sources = []
    for name, wanted in chosen.items():
        view = known[name]
        prefix = f"{name}__" if keep_feature_time or any(names.count(f) > 1 for f in wanted) else ""
        sources.append(Source(view.conform(tables[name]), view.contract, tuple(wanted), view.ttl, prefix))
    return asof_join(spine, sources, contract, keep_feature_time)


def latest_rows(
    df: DataFrame,
    features: Sequence[str],
    contract: Contract = Contract(),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Latest row per entity with time in [start, end]: what the online table holds.

    Aggregates before the shuffle, one row per entity and task. With a unique (entity, time) every
    column keeps its own hash-aggregated maximum; tie columns need the whole row compared.
    """
    kind = df.schema[contract.time].dataType  # bounds of the column's own type reach the file scan
    if start is not None:
        df = df.where(F.col(contract.time) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(contract.time) <= F.lit(end).cast(kind))
    grouped = df.groupBy(*contract.entity)
    if not contract.tie:
        newest = [F.max_by(f, contract.time).alias(f) for f in features]
        return grouped.agg(F.max(contract.time).alias(contract.time), *newest)
    row = F.max_by(F.struct(contract.time, *features), F.struct(*contract.order)).alias("__r")
    return grouped.agg(row).select(*contract.entity, "__r.*")


def latest_lookup(
    keys: DataFrame, latest: DataFrame, contract: Contract = Contract(), features: Sequence[str] | None = None
) -> DataFrame:
    """Online lookup: latest values for the keys, without a time; unknown keys give NULLs."""
    wanted = features or [c for c in latest.columns if c not in contract.key]
    return keys.join(latest.select(*contract.entity, *wanted), list(contract.entity), "left")


def freshness(latest: DataFrame, as_of: Column, ttl: timedelta, contract: Contract = Contract()) -> DataFrame:
    """Entities with the age of their latest row and whether it is older than the ttl."""
    age = (F.unix_micros(as_of.cast("timestamp")) - micros(contract.time)) / F.lit(1_000_000.0)
    return latest.select(
        *contract.entity, contract.time, age.alias("age_s"), (F.col(contract.time) < as_of - F.lit(ttl)).alias("stale")
    )


def skew_check(offline: DataFrame, online: DataFrame, features: Sequence[str], entity: Sequence[str]) -> DataFrame:
    """Cell-by-cell comparison of training and serving values; one row per entity of either side."""
    left = offline.select(*entity, F.lit(True).alias("__l"), *[F.col(f).alias(f"__l_{f}") for f in features])
    right = online.select(*entity, F.lit(True).alias("__r"), *[F.col(f).alias(f"__r_{f}") for f in features])
    both = left.join(right, list(entity), "full_outer")
    differs = [(~F.col(f"__l_{f}").eqNullSafe(F.col(f"__r_{f}"))).cast("int") for f in features]
    return both.select(
        *entity,
        F.col("__l").isNotNull().alias("in_offline"),
        F.col("__r").isNotNull().alias("in_online"),
        sum(differs[1:], differs[0]).alias("n_different"),
    )


def naive_join(spine: DataFrame, latest: DataFrame, features: Sequence[str], contract: Contract = Contract()) -> DataFrame:
    """The wrong join: latest row per entity whatever its time. Kept as a comparator for audits."""
    right = latest.select(*contract.entity, F.col(contract.time).alias("feature_ts"), *features)
    return spine.join(right, list(contract.entity), "left")


def leak_audit(joined: DataFrame, feature_time: str = "feature_ts", time: str = "event_timestamp") -> DataFrame:
    """How many rows use a feature from after their own time."""
    return joined.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(feature_time).alias("n_matched"),
        F.count_if(F.col(feature_time) > F.col(time)).alias("n_leaking"),
    )


def entity_coverage(spine: DataFrame, features: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Entities only asked for, only stored, or both."""
    sides = [d.select(*entity, F.lit(i).alias("__side")) for i, d in enumerate((spine, features))]
    seen = sides[0].unionByName(sides[1]).groupBy(*entity).agg(F.min("__side").alias("low"), F.max("__side").alias("high"))
    kind = F.when(F.col("low") != F.col("high"), "both").when(F.col("low") == 0, "spine_only").otherwise("features_only")
    return seen.select(*entity, kind.alias("coverage"))


def match_coverage(
    joined: DataFrame, feature_times: Mapping[str, str], time: str = "event_timestamp"
) -> DataFrame:
    """Per view: spine rows, rows without a match, their share, and the age of the matches in seconds.

    Many missing rows point to a short ttl, old matches to a long one. One pass for all views.
    """
    aggregates, lines = [F.count(F.lit(1)).alias("n")], []
    for i, (view, column) in enumerate(feature_times.items()):
        age = (micros(time) - micros(column)) / F.lit(1_000_000.0)
        aggregates += [F.count(column).alias(f"m{i}")]
        aggregates += [f(age).alias(f"{a}{i}") for a, f in (("lo", F.min), ("avg", F.avg), ("hi", F.max))]
        missing = F.col("n") - F.col(f"m{i}")
        lines.append(
            F.struct(
                F.lit(view).alias("view"),
                F.col("n").alias("n_spine"),
                missing.alias("n_missing"),
                F.try_divide(missing, F.col("n")).alias("share_missing"),
                F.col(f"lo{i}").alias("min_age_s"),
                F.col(f"avg{i}").alias("mean_age_s"),
                F.col(f"hi{i}").alias("max_age_s"),
            )
        )
    return joined.agg(*aggregates).select(F.inline(F.array(*lines)))
