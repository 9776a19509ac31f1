"""Lags of hot entities in one pass; ratio splits by the keys at the cuts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventfeat.operators.sequence import lag_features, ratio_split

DAY = dt.datetime(2020, 1, 1)


def _rows(n=900, seed=5):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *[DAY + dt.timedelta(hours=rng.randint(0, 30_000))] * 9]), k, k * 1.5) for k in range(n)]


def _plain(rows):
    out, last = {}, {}
    for e, t, k, v in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or DAY, r[2])):
        out[k] = last.get(e) if e is not None else None
        last[e] = k
    return out


SCHEMA = "e string, ts timestamp_ntz, k int, v double"


@pytest.mark.parametrize("bucket", ["auto", None, 3600, 86400 * 7, 1e9])
def test_lag_does_not_depend_on_buckets(spark, bucket):
    rows = _rows()
    got = lag_features(spark.createDataFrame(rows, SCHEMA), "e", ["ts", "k"], ["k"], bucket_s=bucket)
    assert {r["k"]: r["prev_k"] for r in got.collect()} == _plain(rows)


def test_lag_runs_its_input_once_and_spreads_a_hot_entity(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    rows = [("hot" if k % 3 else f"e{k}", DAY + dt.timedelta(hours=k), k, 0.0) for k in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA).mapInArrow(count, SCHEMA)
    lagged = lag_features(df, "e", ["ts", "k"], ["k"])
    got = {r["k"]: r["prev_k"] for r in lagged.select("k", "prev_k").collect()}
    assert runs.value == 20_000 and got == _plain(rows)
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert "_b" in plan and plan.count("hashpartitioning(e") >= 2


@pytest.mark.parametrize("parts", [1, 64, 200])
def test_ratio_split_has_exact_counts(spark, parts):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), k) for k in range(1003)]
    df = spark.createDataFrame(rows, "t int, id int")
    got = ratio_split(df, "t", [0.6, 0.2], tiebreak="id", partitions=parts).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = {r[1]: "train" if i < 601 else "val" if i < 801 else "test" for i, r in enumerate(order)}
    assert {r["id"]: r["split"] for r in got} == want


def test_ratio_split_moves_only_keys(spark):
    df = spark.range(500).selectExpr("id", "id % 50 AS t", "repeat('x', 100) AS wide")
    out = ratio_split(df, "t", [0.5, 0.25], tiebreak="id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0]
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 250, "val": 125, "test": 125}


def test_ratio_split_between_equal_keys(spark):
    df = spark.range(1000).selectExpr("CAST(1 AS INT) AS t", "id AS other")
    got = {r["split"]: r["count"] for r in ratio_split(df, "t", [0.6, 0.2], partitions=8).groupBy("split").count().collect()}
    assert got == {"train": 600, "val": 200, "test": 200}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_ratio_split_of_few_rows(spark, n):
    got = ratio_split(spark.range(n).selectExpr("id AS t"), "t", [0.5, 0.2]).groupBy("split").agg(F.count("*").alias("n")).collect()
    assert {r["split"]: r["n"] for r in got} == {0: {}, 1: {"test": 1}, 2: {"train": 1, "test": 1}}[n]
