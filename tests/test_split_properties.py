"""Time-order properties of splits and folds on the orders table (sf0.01)."""

from pyspark.sql import functions as F

from eventfeat.operators import sequence as S
from eventfeat.operators import split as V

D = "/root/testdata/sf0.01"


def _orders(spark):
    return spark.read.parquet(f"{D}/orders.parquet").select("o_orderkey", "o_orderdate", "o_orderstatus")


def test_horizon_split_is_ordered_partition(spark):
    o = _orders(spark)
    s = V.horizon_split(o, "o_orderdate", "1995-01-01", 48, 12, drop_outside=False)
    span = s.groupBy("split").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"), F.count("*").alias("n"))
    r = {x["split"]: x for x in span.collect()}
    assert r["train"]["hi"] < r["test"]["lo"]
    assert sum(x["n"] for x in r.values()) == o.count()           # every row exactly once


def test_ratio_split_ranks_are_monotone(spark):
    o = _orders(spark)
    s = S.ratio_split(o, "o_orderdate", [0.6, 0.2], tiebreak="o_orderkey")
    n = o.count()
    c = {x["split"]: x["count"] for x in s.groupBy("split").count().collect()}
    assert c == {"train": int(n * 0.6), "val": int(n * 0.2), "test": n - int(n * 0.6) - int(n * 0.2)}
    b = {x["split"]: x for x in s.groupBy("split").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("lo"),
                                                       F.max(F.struct("o_orderdate", "o_orderkey")).alias("hi")).collect()}
    assert tuple(b["train"]["hi"]) < tuple(b["val"]["lo"]) and tuple(b["val"]["hi"]) < tuple(b["test"]["lo"])


def test_folds_are_disjoint_in_time_and_downsample_keeps_minority(spark):
    o = _orders(spark).filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    folds = V.rolling_windows(o, "o_orderdate", 24, 12, 12)
    tagged = V.assign_folds(o, "o_orderdate", folds)
    per = tagged.groupBy("fold", "role").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).collect()
    spans = {(x["fold"], x["role"]): (x["lo"], x["hi"]) for x in per}
    for f in {k[0] for k in spans}:
        assert spans[(f, "train")][1] < spans[(f, "val")][0]
    assert tagged.groupBy("fold", "role", "o_orderkey").count().filter("count > 1").count() == 0
    y = o.withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    d = V.downsample(y, "y", "o_orderkey")
    assert d.filter("y = 1").count() == y.filter("y = 1").count()
    assert d.filter("y = 0").count() < y.filter("y = 0").count()
    assert d.exceptAll(V.downsample(y.repartition(7), "y", "o_orderkey")).count() == 0   # same rows on any partitioning
