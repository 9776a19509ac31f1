"""Ordered-neighbour joins against brute force on random data with a hot key,
duplicate timestamps, NULL keys and every bucketing path."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventfeat.operators.asof import asof_join, nearest_per_key
from eventfeat.operators.sequence import lag_features, top1

T0 = dt.datetime(2024, 1, 1)


def _events(n, seed, hot_share=0.4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randint(1, 6)
        if rnd.random() < 0.03:
            k = None
        ts = T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 6))
        rows.append((i, k, ts, rnd.random()))
    return rows


def _brute_asof(left, right, offset_s, tol_s, inclusive=True):
    out = {}
    for lid, lk, lts, _ in left:
        best = None
        if lk is not None:
            target = lts - dt.timedelta(seconds=offset_s)
            for rid, rk, rts, rv in right:
                if rk != lk:
                    continue
                ok = rts <= target if inclusive else rts < target
                if tol_s is not None:
                    ok = ok and (target - rts).total_seconds() <= tol_s
                if ok and (best is None or (rts, -rid) > (best[1], -best[0])):
                    best = (rid, rts)
        out[lid] = best[0] if best else None
    return out


@pytest.mark.parametrize("tol,bucket,inclusive", [
    (8 * 3600, None, True), (8 * 3600, 24 * 3600, True), (None, None, True), (None, 6 * 3600, True),
    (3 * 3600, 3 * 3600, False), (None, 2 * 3600, False)])
def test_asof_matches_brute_force(spark, tol, bucket, inclusive):
    left, right = _events(300, 1), _events(400, 2)
    # force exact-time ties between the sides and inside the right side
    right += [(1000 + i, r[1], r[2], 0.5) for i, r in enumerate(right[:40])]
    right += [(2000 + i, l[1], l[2] - dt.timedelta(hours=1), 0.5) for i, l in enumerate(left[:30])]
    sch = "id long, k long, ts timestamp_ntz, v double"
    L, R = spark.createDataFrame(left, sch), spark.createDataFrame(right, sch)
    if tol is None and bucket is not None:
        res = asof_join(L, R, "k", "ts", "ts", offset_s=3600, tolerance_s=None, right_cols=["id"], tiebreak="id",
                        prefix="r_", bucket_s=bucket, inclusive=inclusive)
    else:
        res = asof_join(L, R, "k", "ts", "ts", offset_s=3600, tolerance_s=tol, right_cols=["id"], tiebreak="id",
                        prefix="r_", bucket_s=bucket, inclusive=inclusive)
    got = {r["id"]: r["r_id"] for r in res.select("id", "r_id").collect()}
    assert res.count() == len(left)
    assert got == _brute_asof(left, right, 3600, tol, inclusive)


@pytest.mark.parametrize("bucket", [None, 0.05, 0.2])
def test_nearest_matches_brute_force(spark, bucket):
    rnd = random.Random(5)
    left = [(i, rnd.choice([0, 0, 0, 1, 2, None]), round(rnd.random(), 2)) for i in range(300)]
    cands = [(100 + j, rnd.choice([0, 0, 1, 2]), round(rnd.random(), 2)) for j in range(60)]
    L = spark.createDataFrame(left, "id long, g long, x double")
    C = spark.createDataFrame(cands, "cid long, cg long, cx double")
    res = nearest_per_key(L, C, "g", "x", "cx", "cid", cand_by="cg", cand_cols=["cid"], bucket_width=bucket)
    got = {r["id"]: r["cid"] for r in res.collect()}
    exp = {}
    for i, g, x in left:
        best = None
        for cid, cg, cx in cands:
            if g is None or cg != g:
                continue
            key = (abs(x - cx), cid)
            if best is None or key < best:
                best = key
        exp[i] = best[1] if best else None
    assert got == exp


@pytest.mark.parametrize("bucket", [None, 3600.0, 86400.0])
def test_lag_matches_pandas(spark, bucket):
    rows = _events(500, 9)
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v double")
    res = lag_features(df, "k", ["ts", "id"], ["id", "v"], bucket_s=bucket)
    got = {r["id"]: r["prev_id"] for r in res.select("id", "prev_id").collect()}
    pdf = pd.DataFrame(rows, columns=["id", "k", "ts", "v"])
    exp = {}
    for k, g in pdf[pdf.k.notna()].groupby("k"):
        g = g.sort_values(["ts", "id"])
        prev = [None] + list(g.id[:-1])
        exp.update(dict(zip(g.id, prev)))
    exp.update({i: None for i in pdf[pdf.k.isna()].id})
    assert got == exp


def test_top1_is_latest(spark):
    rows = _events(200, 4)
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v double").filter(F.col("k").isNotNull())
    got = {r["k"]: r["id"] for r in top1(df, "k", ["ts", "id"]).collect()}
    pdf = pd.DataFrame([r for r in rows if r[1] is not None], columns=["id", "k", "ts", "v"])
    exp = {k: g.sort_values(["ts", "id"]).id.iloc[-1] for k, g in pdf.groupby("k")}
    assert got == exp


def test_hot_key_is_spread_over_partitions(spark):
    """One key with 40% of the rows: with time buckets no shuffle partition of the
    as-of join holds more than a small share of the rows; without, one does."""
    rnd = random.Random(11)
    rows = [(i, 0 if rnd.random() < 0.4 else rnd.randint(1, 500), T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 60)), 0.0)
            for i in range(20000)]
    sch = "id long, k long, ts timestamp_ntz, v double"
    df = spark.createDataFrame(rows, sch)
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        def max_share(bucket):
            r = asof_join(df, df.select("k", "ts", F.col("id").alias("rid")), "k", "ts", "ts", offset_s=60,
                          tolerance_s=None if bucket is None else 6 * 3600, right_cols=["rid"], bucket_s=bucket)
            # rows per output partition of the window stage (the shuffle on (key, bucket))
            sizes = r.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
            return max(sizes) / len(rows)
        assert max_share(6 * 3600) < 0.05
        assert max_share(None) > 0.35
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_entity_lag_is_spread(spark):
    rnd = random.Random(12)
    rows = [(i, 0 if rnd.random() < 0.4 else rnd.randint(1, 500), T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 60)), 0.0)
            for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v double")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        def max_share(bucket):
            r = lag_features(df, "k", ["ts", "id"], ["id"], bucket_s=bucket)
            sizes = r.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
            return max(sizes) / len(rows)
        assert max_share(86400.0) < 0.05
        assert max_share(None) > 0.35
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_map_columns_and_null_keys_pass_through(spark):
    df = spark.createDataFrame([(1, None, T0, {"a": 1}), (2, 5, T0, {"b": 2})], "id long, k long, ts timestamp_ntz, m map<string,int>")
    r = asof_join(df, df.select("k", "ts", F.col("id").alias("rid")), "k", "ts", "ts", right_cols=["rid"])
    got = {x["id"]: x["rid"] for x in r.collect()}
    assert got == {1: None, 2: 2}
    lg = {x["id"]: x["prev_id"] for x in lag_features(df, "k", ["ts", "id"], ["id"]).collect()}
    assert lg == {1: None, 2: None}
