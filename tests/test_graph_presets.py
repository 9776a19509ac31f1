"""PageRank against a dense power iteration; calendar rule; split helpers."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from eventfeat.operators.graph import pagerank, salted_edges, weighted_degrees
from eventfeat.operators.split import rolling_windows
from eventfeat.plans.presets import us_holidays


def _numpy_pagerank(edges, alpha=0.85, tol=1e-6):
    nodes = sorted({s for s, _, _ in edges} | {d for _, d, _ in edges})
    ix = {n: i for i, n in enumerate(nodes)}
    n = len(nodes)
    W = np.zeros((n, n))
    for s, d, w in edges:
        W[ix[s], ix[d]] += w
    ow = W.sum(1)
    P = np.divide(W, ow[:, None], out=np.zeros_like(W), where=ow[:, None] > 0)
    x = np.ones(n) / n
    for _ in range(100):
        xl = x
        x = alpha * (xl @ P + xl[ow == 0].sum() / n) + (1 - alpha) / n
        if np.abs(x - xl).sum() < n * tol:
            return dict(zip(nodes, x))
    raise AssertionError


def test_pagerank_with_dangling_node(spark):
    edges = [("A", "B", 3), ("B", "C", 1), ("C", "A", 2), ("A", "C", 1), ("C", "D", 5), ("E", "A", 1)]  # D dangling
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    got = {r["node"]: r["pagerank"] for r in pagerank(df).collect()}
    exp = _numpy_pagerank(edges)
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)
    deg = {r["node"]: (r["in_degree"], r["out_degree"]) for r in weighted_degrees(df).collect()}
    assert deg["D"] == (5.0, 0.0) and deg["E"] == (0.0, 1.0)


def test_hub_sources_spread_and_rank_alike(spark):
    """A source with a third of all edges, and a target with another third."""
    edges = [("hub", f"n{k}", 1 + k % 3) for k in range(600)] + [(f"n{k}", "sink", 1) for k in range(600)]
    edges += [(f"n{k}", f"n{(k * 7) % 600}", 2) for k in range(600)]
    df = spark.createDataFrame(edges, "src string, dst string, weight long").repartition(16)
    salted = salted_edges(df.withColumn("w", F.col("weight").cast("double")), 16)
    sizes = [r["n"] for r in salted.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1800 and max(sizes) < 1800 * 0.2      # 113 a partition on average, the hub alone has 600
    assert salted.filter("src <> 'hub'").agg(F.max("salts")).first()[0] == 1
    got, want = {r["node"]: r["pagerank"] for r in pagerank(df).collect()}, _numpy_pagerank(edges)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_path_that_takes_many_steps(spark):
    edges = [(k, k + 1, 1) for k in range(60)]
    got = {r["node"]: r["pagerank"] for r in pagerank(spark.createDataFrame(edges, "src long, dst long, weight long")).collect()}
    want = _numpy_pagerank(edges)
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_calendar_rule_reproduces_known_dates():
    cal = dict(us_holidays(2015, 2019))
    assert len(cal) == 55
    for d, name in [("2015-01-19", "Martin Luther King Jr. Day"), ("2016-05-30", "Memorial Day"),
                    ("2017-11-23", "Thanksgiving Day"), ("2018-10-08", "Columbus Day"),
                    ("2019-09-02", "Labor Day"), ("2019-12-24", "Christmas Eve")]:
        assert cal[d] == name


@pytest.mark.parametrize("train,val,step,expected", [(1, 1, 1, 1), (2, 1, 1, 3), (3, 1, 1, 6), (24, 12, 12, 2)])
def test_rolling_fold_counts(spark, train, val, step, expected):
    """Fold counts of the four horizons as recorded by the source (1/3/6/2)."""
    import datetime as dt
    spans = {1: ("2015-01-01", "2015-02-28"), 2: ("2015-01-01", "2015-05-31"), 3: ("2019-01-01", "2019-09-30"),
             24: ("2015-01-01", "2018-12-31")}
    a, b = spans[train]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(a),), (dt.datetime.fromisoformat(b),)], "ts timestamp_ntz")
    assert rolling_windows(df, "ts", train, val, step).count() == expected


def test_rolling_folds_accumulate_month_end_clipping(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2019, 1, 31),), (dt.datetime(2019, 8, 30),)], "ts timestamp_ntz")
    rows = [(r["fold"], str(r["train_start"]), str(r["val_start"]), str(r["val_end"]))
            for r in rolling_windows(df, "ts", 1, 1, 1).orderBy("fold").collect()]
    # val starts: Jan31+1m = Feb28, +1m = Mar28, +1m = Apr28 ... (clipping carried forward)
    assert rows[0] == (1, "2019-01-28", "2019-02-28", "2019-03-28")
    assert rows[1] == (2, "2019-02-28", "2019-03-28", "2019-04-28")
    assert len(rows) == 6
