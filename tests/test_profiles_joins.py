"""Null-profile set differences (A5), target encoding fallback (J10), fallback enrichment."""

from pyspark.sql import functions as F

from eventfeat.operators import joins as J
from eventfeat.operators import profile as P


def test_null_profile_and_expected_report(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, 2.0, None)], "a int, b double, c string")
    prof = {r["column"]: (r["null_count"], round(r["null_pct"], 6)) for r in P.null_profile(df).collect()}
    assert prof == {"a": (1, 33.333333), "b": (2, 66.666667), "c": (1, 33.333333)}
    rep = P.expected_nulls_report(P.null_profile(df), expected=["b", "z"], present=df.columns)
    assert rep == {"missing_expected": ["z"], "unexpected_nulls": ["a", "c"], "expected_without_nulls": ["z"]}


def test_target_encoding_unseen_key_gets_global_mean(spark):
    train = spark.createDataFrame([("x", 1), ("x", 0), ("y", 1)], "k string, y int")
    test = spark.createDataFrame([("x",), ("y",), ("new",), (None,)], "k string")
    enc = J.fit_target_encoding(train, "k", "y")
    got = {r["k"]: r["k_te"] for r in enc.apply(test).collect()}
    assert got == {"x": 0.5, "y": 1.0, "new": 2 / 3, None: 2 / 3}


def test_fallback_fills_missing_rows_and_null_values(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "key int")
    primary = spark.createDataFrame([(1, "p1", None), (2, None, 20)], "key int, name string, size int")
    backup = spark.createDataFrame([(1, "b1", 10), (2, "b2", 21), (3, "b3", 30)], "key int, name string, size int")
    out = {r["key"]: (r["name"], r["size"]) for r in
           J.enrich_with_fallback(fact, primary, backup, "key", "key", ["name", "size"]).collect()}
    assert out == {1: ("p1", 10), 2: ("b2", 20), 3: ("b3", 30)}
