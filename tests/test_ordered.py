"""Sliced plans give what plain windows give, whatever the skew."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import features as fx
from tidemark.operators import store as st
from tidemark.plans import ordered as od

T0 = datetime(2024, 1, 1)
KEY = Contract(("k",), "ts")


def skewed(spark, n=400, seed=3, null_share=0.0):
    """A third of all rows belong to entity 'hot'; another part to the NULL entity."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        u = draw.random()
        key = "hot" if u < 0.34 else None if u < 0.34 + null_share else f"k{draw.randrange(12)}"
        value = None if draw.random() < 0.05 else round(draw.gauss(50, 9), 2)
        rows.append((key, T0 + timedelta(seconds=i * 7 + draw.random()), value))
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")


def rows(df, places=9):
    rounded = df.select([F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    return sorted(map(repr, rounded.select(sorted(rounded.columns)).collect()))


@pytest.mark.parametrize("limit", ["5", "40"])
def test_windows_do_not_depend_on_slicing(spark, limit):
    df = skewed(spark, null_share=0.2)
    features = [
        fx.Feature("m", "v", "mean", 4),
        fx.Feature("s", "v", "std", 7),
        fx.Feature("d", "v", "delta", strict=True),
        fx.Feature("l", "v", "lag", 6),
    ]
    plain = rows(fx.build_features(df, features, KEY))
    expanding = rows(fx.expanding_mean(df, "v", KEY))
    windows = rows(fx.supervised_windows(df.fillna(0.0), "v", 5, 3, KEY))
    spark.conf.set("spark.tidemark.rowsPerTask", limit)
    try:
        assert rows(fx.build_features(df, features, KEY)) == plain
        assert rows(fx.expanding_mean(df, "v", KEY)) == expanding
        assert rows(fx.supervised_windows(df.fillna(0.0), "v", 5, 3, KEY)) == windows
    finally:
        spark.conf.unset("spark.tidemark.rowsPerTask")


def test_large_groups_are_split_over_many_slices(spark, sliced):
    df = skewed(spark)
    slices = od.find_slices(df, ["k"], ["ts"])
    counts = slices.assign(df).groupBy("k", od.SLICE).count().collect()
    hot = [r["count"] for r in counts if r["k"] == "hot"]
    assert len(hot) > 3 and max(hot) <= 60
    assert all(r[od.SLICE] == 0 for r in counts if r["k"] is not None and r["k"] != "hot")


def test_asof_with_hot_entity_and_copies(spark):
    spine, features = skewed(spark, 300, 1), skewed(spark, 300, 2)
    copies = spine.unionByName(spine.where("k = 'hot'").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(90)))).drop("n"))
    source = [st.Source(features.withColumnRenamed("v", "f"), KEY, ("f",), timedelta(minutes=5))]
    plain = rows(st.asof_join(copies, source, KEY, keep_feature_time=True))
    spark.conf.set("spark.tidemark.rowsPerTask", "25")
    try:
        assert rows(st.asof_join(copies, source, KEY, keep_feature_time=True)) == plain
    finally:
        spark.conf.unset("spark.tidemark.rowsPerTask")
    assert len(plain) == copies.count()


def test_running_over_the_whole_table(spark, sliced):
    df = skewed(spark).where("v is not null").select("ts", "v")
    got = od.running(df, [], ["ts"], {"s": ("sum", F.col("v")), "hi": ("max", F.col("v"))}, {"t": F.col("v")})
    whole = Window.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns(
        {"s": F.sum("v").over(whole), "hi": F.max("v").over(whole), "t": F.sum("v").over(Window.partitionBy())}
    )
    assert rows(got, 6) == rows(want, 6)


@pytest.mark.parametrize("position", [1, 37, 200, 399, 400])
def test_exact_cut_finds_the_border_row(spark, sliced, position):
    df = skewed(spark).withColumn("day", F.col("ts").cast("date")).withColumn("k", F.coalesce("k", F.lit("none")))
    ids = df.withColumn("id", F.monotonically_increasing_id() % 5).withColumn("n", F.xxhash64("ts"))
    cut = od.exact_cut(ids, ["day", "id", "n"], position)
    assert ids.where(od.up_to_cut(ids, cut)).count() == position


def test_one_hot_time_is_cut_by_the_next_order_column(spark):
    """Half of the rows share entity and time and differ in the tie column only."""
    df = skewed(spark, 200).withColumn("id", F.xxhash64("ts") % 1000003)
    copies = spark.range(200).select(
        F.lit("hot").alias("k"), F.lit(T0 + timedelta(seconds=700)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") * 1.5).alias("v"), (F.col("id") * 7 % 211).alias("id"),
    )
    both = df.unionByName(copies)
    key = Contract(("k",), "ts", ("id",))
    feature = [fx.Feature("m", "v", "mean", 5), fx.Feature("l", "v", "lag", 3)]
    plain, whole = rows(fx.build_features(both, feature, key)), rows(fx.expanding_mean(both, "v", key), 12)
    spark.conf.set("spark.tidemark.rowsPerTask", "30")
    try:
        slices = od.find_slices(both, ["k"], key.order)
        assert len(slices.levels) == 2
        most = slices.assign(both).where("k = 'hot'").groupBy(od.SLICE).count().agg(F.max("count")).first()[0]
        assert most <= 60
        assert rows(fx.build_features(both, feature, key)) == plain
        assert rows(fx.expanding_mean(both, "v", key), 12) == whole
    finally:
        spark.conf.unset("spark.tidemark.rowsPerTask")


def test_cuts_are_constants_of_the_plan(spark, sliced):
    """Two reads of one table fall into the same slices."""
    df = skewed(spark)
    slices = od.find_slices(df, ["k"], ["ts"])
    one, two = (slices.assign(df).select("ts", od.SLICE) for _ in range(2))
    assert one.exceptAll(two).isEmpty()


@pytest.mark.parametrize("span", [7, 168, 1000])
def test_halo_is_the_span_per_slice_and_gives_plain_windows(spark, sliced, span):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("ts"), (F.col("id") * 7 % 101).alias("x"))
    slices = od.find_slices(df, ["k"], ["ts"])
    cut = slices.assign(df)
    near = od._near_rows(cut, ["k"], ["ts"], span, following=False).groupBy("k", od.SLICE).count().collect()
    assert len(near) > 50 and max(r["count"] for r in near) <= span
    frame = lambda w: {"s": F.sum("x").over(w.rowsBetween(-span, -1)), "t": F.sum("x").over(w.rowsBetween(1, span))}
    got = od.with_window(df, ["k"], ["ts"], frame, before=span, after=span)
    want = df.withColumns(frame(Window.partitionBy("k").orderBy("ts")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
