from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import Contract, FeatureService, FeatureView, predictive_maintenance, resolve_features
from tidemark.operators import store as st

T0 = datetime(2024, 1, 1)
H = timedelta(hours=1)
KEY = Contract(("k",), "ts")


def table(spark, rows, name="f"):
    return spark.createDataFrame(rows, f"k string, ts timestamp_ntz, {name} double")


def spine(spark, *rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz")


def got(df):
    return {(r["k"], r["ts"]): r["f"] for r in df.collect()}


def test_match_is_inclusive_at_both_ends_of_the_ttl(spark):
    source = st.Source(table(spark, [("a", T0, 1.0)]), KEY, ("f",), 2 * H)
    asked = spine(spark, ("a", T0 - H), ("a", T0), ("a", T0 + 2 * H), ("a", T0 + 2 * H + timedelta(microseconds=1)), ("b", T0))
    assert list(got(st.asof_join(asked, [source], KEY)).values()).count(1.0) == 2
    found = got(st.asof_join(asked, [source], KEY))
    assert found[("a", T0)] == 1.0 and found[("a", T0 + 2 * H)] == 1.0 and found[("b", T0)] is None


def test_ties_take_the_last_by_tie_column(spark):
    df = spark.createDataFrame([("a", T0, 1, 1.0), ("a", T0, 3, 3.0), ("a", T0, 2, 2.0)], "k string, ts timestamp_ntz, v int, f double")
    source = st.Source(df, Contract(("k",), "ts", ("v",)), ("f",))
    assert got(st.asof_join(spine(spark, ("a", T0)), [source], KEY)) == {("a", T0): 3.0}


def test_a_missing_feature_value_still_counts_as_the_match(spark):
    source = st.Source(table(spark, [("a", T0, 1.0), ("a", T0 + H, None)]), KEY, ("f",))
    assert got(st.asof_join(spine(spark, ("a", T0 + H)), [source], KEY)) == {("a", T0 + H): None}


def test_null_keys_never_match(spark):
    source = st.Source(table(spark, [(None, T0, 1.0)]), KEY, ("f",))
    assert got(st.asof_join(spine(spark, (None, T0)), [source], KEY)) == {(None, T0): None}


def test_forward_takes_the_next_row(spark):
    source = st.Source(table(spark, [("a", T0, 1.0), ("a", T0 + H, 2.0)]), KEY, ("f",), H)
    found = got(st.asof_join(spine(spark, ("a", T0), ("a", T0 + timedelta(minutes=1)), ("a", T0 + 2 * H)), [source], KEY, direction="forward"))
    assert [found[k] for k in sorted(found)] == [1.0, 2.0, None]


def test_later_features_do_not_reach_back(spark):
    rows = [("a", T0 + i * H, float(i)) for i in range(5)]
    asked = spine(spark, *[("a", T0 + i * H) for i in range(5)])
    changed = [(k, t, f if t < T0 + 3 * H else 99.0) for k, t, f in rows]
    a, b = (got(st.asof_join(asked, [st.Source(table(spark, r), KEY, ("f",))], KEY)) for r in (rows, changed))
    assert all(a[k] == b[k] for k in a if k[1] < T0 + 3 * H)


def test_feature_choice_and_views(spark):
    schema = T.StructType([T.StructField("f", T.FloatType())])
    view = FeatureView("v", schema, KEY, 5 * H)
    service = FeatureService("s", (view,))
    assert resolve_features([view], ["v:f"], service) == {"v": ["f"]}
    assert resolve_features([view], None, service) == {"v": ["f"]}
    with pytest.raises(ValueError):
        resolve_features([view], ["v:g"])
    joined = st.historical_features(spine(spark, ("a", T0 + H)), {"v": table(spark, [("a", T0, 0.1)])}, [view], service=service, contract=KEY)
    assert joined.schema["f"].dataType == T.FloatType()
    with pytest.raises(ValueError):
        view.check(table(spark, [("a", T0, 0.1)]))
    assert predictive_maintenance(2 * H).views[0].features[0] == "temp_roll_mean"


def test_latest_lookup_and_consistency(spark):
    df = table(spark, [("a", T0, 1.0), ("a", T0 + H, 2.0), ("b", T0, 5.0)])
    latest = st.latest_rows(df, ["f"], KEY)
    keys = spark.createDataFrame([("a",), ("zz",)], "k string")
    assert {r["k"]: r["f"] for r in st.latest_lookup(keys, latest, KEY).collect()} == {"a": 2.0, "zz": None}
    now = latest.select("k").withColumn("ts", F.lit(T0 + 9 * H).cast("timestamp_ntz"))
    offline = st.asof_join(now, [st.Source(df, KEY, ("f",))], KEY)
    check = st.skew_check(offline, latest, ["f"], ["k"]).collect()
    assert len(check) == 2 and all(r["n_different"] == 0 for r in check)
    early = st.latest_rows(df, ["f"], KEY, end=T0)
    assert {r["k"]: r["f"] for r in early.collect()} == {"a": 1.0, "b": 5.0}
