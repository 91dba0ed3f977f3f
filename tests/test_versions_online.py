"""Versions that share parts, and an online table kept up to date by steps."""

import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import store as st
from tidemark.operators.online import OnlineTable
from tidemark.sources.trees import TreeStore

T0 = datetime(2024, 1, 1)
LOG = Contract(("k",), "ts")


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet") if p.is_file()}


@pytest.fixture
def table(spark):
    made = [(i % 7, i, f"t{i % 3}", None if i % 5 == 0 else i / 2) for i in range(200)] + [(6, 6, "t0", 3.0)] * 3
    return spark.createDataFrame([*made, (None, 1, "x", 1.0)], "part int, k int, name string, v double").repartition(3)


def test_only_changed_parts_are_written(spark, table, tmp_path):
    store = TreeStore(spark, str(tmp_path), F.col("part"))
    first = store.save(table)
    assert (first.parts, first.written) == (8, 8)
    before = files(tmp_path / "objects")
    edited = table.withColumn("v", F.when(F.col("part") == 2, F.col("v") + 1).otherwise(F.col("v"))).where("not part <=> 4 or k < 100")
    second = store.save(edited)
    assert (second.parts, second.written) == (8, 2)
    after = files(tmp_path / "objects")
    assert before.items() <= after.items() and len({p.split("/")[0] for p in after.keys() - before.keys()}) == 2
    assert {r["__part"] for r in store.changed_parts(first.root, second.root).collect()} == {"2", "4"}
    assert rows(store.restore(first.root)) == rows(table) and rows(store.restore(second.root)) == rows(edited)
    assert store.save(table.repartition(5)).written == 0 and store.save(table).root == first.root
    assert files(tmp_path / "objects") == after
    assert store.is_current(first.root, table.coalesce(1)) and not store.is_current(first.root, edited)


def test_diff_reads_only_parts_that_differ(spark, table, tmp_path):
    store = TreeStore(spark, str(tmp_path), F.col("part"))
    old = store.save(table).root
    extra = spark.createDataFrame([(3, 999, "new", None), (9, 1000, "new", 1.0), (6, 6, "t0", 3.0)], table.schema)
    new = store.save(table.where("k <> 10").unionByName(extra)).root
    found = store.diff(old, new)
    digests = {r[0] for side, at in (("old", old), ("new", new)) for r in store.changed_parts(old, new).select(side).dropna().collect()}
    read = {re.search("__digest=([^/]+)", f)[1] for f in found.inputFiles()}
    assert read == digests and len(read) < store.manifest(old).count() * 2
    assert sorted((r.k, r.change) for r in found.collect()) == [(6, "added"), (10, "removed"), (999, "added"), (1000, "added")]
    assert store.diff(old, old).count() == 0


def test_lost_saves_and_empty_tables(spark, tmp_path):
    """What an interrupted save has left is written again, as no version names it; repeated rows stay repeated."""
    df = spark.createDataFrame([(p, v) for p in range(3) for v in (1, 1, 2)], "part int, v int")
    store = TreeStore(spark, str(tmp_path / "same"), F.col("part"))
    saved = store.save(df)
    manifest = tmp_path / "same" / "versions" / f"__root={saved.root}"
    for f in [manifest / "_SUCCESS", *manifest.glob("*.parquet")]:
        f.unlink()
    again = store.save(df)
    assert again.root == saved.root and again.written == 3 and rows(store.restore(again.root)) == rows(df)
    assert store.restore(store.save(df.where("false")).root).count() == 0


def log(spark, n, start=0):
    made = [((i * 7) % 23, T0 + timedelta(minutes=start + i), float(start + i), f"s{i % 4}") for i in range(n)]
    return spark.createDataFrame([*made, (None, T0 + timedelta(minutes=start), 0.0, "x")], "k long, ts timestamp_ntz, v double, s string")


def test_steps_equal_one_run(spark, tmp_path):
    df = log(spark, 500)
    online = OnlineTable(spark, str(tmp_path / "online_a"), df.schema, ["v", "s"], LOG, parts=4, buckets=3)
    assert online.mark() is None and online.rows().count() == 0
    ends = [T0 + timedelta(minutes=m) for m in (100, 101, 101, 350, 600)]
    for end in ends:
        online.step(df, end, T0 + timedelta(minutes=10))
    want = st.latest_rows(df.dropna(subset=["k"]), ["v", "s"], LOG, T0 + timedelta(minutes=10), ends[-1])
    assert rows(online.rows()) == rows(want) and online.mark() == ends[-1]
    # a session that comes later finds rows and mark
    spark.sql(f"DROP TABLE {online.name}")
    again = OnlineTable(spark, str(tmp_path / "online_a"), df.schema, ["v", "s"], LOG, parts=4, buckets=3)
    assert rows(again.rows()) == rows(want) and again.mark() == ends[-1]


def test_a_step_touches_its_parts_and_moves_no_old_row(spark, tmp_path):
    df = log(spark, 300)
    online = OnlineTable(spark, str(tmp_path / "online_b"), df.schema, ["v"], LOG, parts=8)
    online.step(df, T0 + timedelta(minutes=250))
    before = files(tmp_path / "online_b" / "rows")
    new = df.where("k = 5")
    assert online.step(new, T0 + timedelta(minutes=400)) == 1
    after = files(tmp_path / "online_b" / "rows")
    changed = {p.split("/")[0] for p in before.keys() ^ after.keys()} | {p.split("/")[0] for p in before if p in after and before[p] != after[p]}
    assert len(changed) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = st.latest_rows(new, ["v"], LOG).withColumn("__part", F.lit(1))
        plan = online.merged(latest, [1])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    old = plan[plan.index("Bucketed: true") - 2000 :] if "Bucketed: true" in plan else ""
    assert old, plan
    scans = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "online_b" in line)
    over, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            over.append(line)
    assert scans and not any("Exchange" in line for line in over)


def test_late_rows_within_the_lookback(spark, tmp_path):
    df = log(spark, 100)
    online = OnlineTable(spark, str(tmp_path / "online_c"), df.schema, ["v"], LOG)
    online.step(df.where("k <> 3"), T0 + timedelta(minutes=99))
    late = df.where("k in (3, 5) and v > 80")
    online.step(late, T0 + timedelta(minutes=120), lookback=timedelta(minutes=60))
    want = st.latest_rows(df.where("k <> 3").unionByName(late).dropna(subset=["k"]), ["v"], LOG)
    assert rows(online.rows()) == rows(want)
