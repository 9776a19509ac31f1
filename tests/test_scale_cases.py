"""Cases that small or narrow tables hide: wide rows over many range partitions, long
spans, ties of any type, sub-second tolerances, large medians, NULL groups, shared keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventfeat.operators import evaluate as E
from eventfeat.operators import joins as J
from eventfeat.operators import profile as P
from eventfeat.operators import sequence as S
from eventfeat.operators import split as V
from eventfeat.operators.asof import asof_join, nearest_per_key


@pytest.mark.parametrize("parts", [64, 200])
def test_ratio_split_counts_on_a_wide_table(spark, tmp_path, parts):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    out = S.ratio_split(li, "l_shipdate", [0.6, 0.2], tiebreak=["l_orderkey", "l_linenumber"], partitions=parts)
    out.write.parquet(f"{tmp_path}/s{parts}")
    got = {r.split: r["count"] for r in spark.read.parquet(f"{tmp_path}/s{parts}").groupBy("split").count().collect()}
    n = li.count()
    assert got == {"train": int(n * 0.6), "val": int(n * 0.2), "test": n - int(n * 0.6) - int(n * 0.2)}


def test_more_folds_than_any_fixed_bound(spark):
    df = spark.createDataFrame([(dt.date(1900, 1, 1),), (dt.date(2026, 1, 1),)], "d date")
    folds = V.rolling_windows(df, "d", 1, 1, 1)
    assert folds.count() == 1511
    assert folds.agg(F.max("val_end")).first()[0] == dt.date(2026, 1, 1)
    assert V.rolling_windows(df.limit(0), "d", 1, 1, 1).count() == 0


def _ties(spark):
    base = dt.datetime(2020, 1, 1)
    left = spark.createDataFrame([("k", base + dt.timedelta(seconds=s), n) for n, s in enumerate((5, 12, 47, 100, 330))], "k string, t timestamp_ntz, n int")
    rows = [("k", base + dt.timedelta(seconds=s), i) for s in (0, 10, 40, 90, 300) for i in ("x2", "x1", None, "x3")]
    return left, rows


@pytest.mark.parametrize("bucket", [None, 7, 10, 1000])
def test_asof_string_ties_do_not_depend_on_buckets(spark, bucket):
    left, rows = _ties(spark)
    some = [r for r in rows if r[2] is not None]
    for rs, want in ((some, "x1"), (rows, None)):
        right = spark.createDataFrame(rs, "k string, rt timestamp_ntz, id string").repartition(3)
        got = asof_join(left, right, "k", "t", "rt", tiebreak="id", bucket_s=bucket).select("n", "id").collect()
        assert {r.id for r in got} == {want} and len(got) == 5


def test_nearest_string_ties_do_not_depend_on_buckets(spark):
    left = spark.createDataFrame([("a", 25.0), ("a", 4.0)], "k string, v double")
    right = spark.createDataFrame([("a", 20.0, "x2"), ("a", 20.0, "x1"), ("a", 3.0, "y2"), ("a", 3.0, "y1")], "k string, c double, id string")
    for width in (None, 10.0, 3.0):
        got = {(r.v, r.id) for r in nearest_per_key(left, right, "k", "v", "c", "id", bucket_width=width).collect()}
        assert got == {(25.0, "x1"), (4.0, "y1")}


def test_asof_smallest_long_tiebreak(spark):
    left, _ = _ties(spark)
    low = -(2 ** 63)
    right = spark.createDataFrame([("k", dt.datetime(2020, 1, 1), i) for i in (5, low, 7)], "k string, rt timestamp_ntz, id long")
    for bucket in (None, 10):
        assert {r.id for r in asof_join(left, right, "k", "t", "rt", tiebreak="id", bucket_s=bucket).collect()} == {low}


@pytest.mark.parametrize("gap,hit", [(0.45, True), (0.5, True), (0.51, False)])
def test_asof_tolerance_below_a_second(spark, gap, hit):
    t = dt.datetime(2020, 1, 1, 0, 0, 1, 200000)
    left = spark.createDataFrame([("k", t)], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("k", t - dt.timedelta(seconds=gap), 1)], "k string, rt timestamp_ntz, id int")
    for bucket in (None, 60):
        got = asof_join(left, right, "k", "t", "rt", tolerance_s=0.5, tiebreak="id", bucket_s=bucket).first()
        assert (got.id == 1) == hit


def test_asof_without_tiebreak_is_the_same_on_any_partitioning(spark):
    left, _ = _ties(spark)
    rows = [("k", dt.datetime(2020, 1, 1), i, f"v{i}") for i in range(40)]
    got = set()
    for n in (1, 2, 3, 5):
        right = spark.createDataFrame(rows[n:] + rows[:n], "k string, rt timestamp_ntz, id int, v string").repartition(n)
        got |= {r.id for r in asof_join(left, right, "k", "t", "rt", bucket_s=10 * n).collect()}
    assert len(got) == 1


def test_median_of_many_rows_is_exact(spark):
    assert P.fit_median(spark.range(20_000_001).select(F.col("id").cast("double").alias("v")), "v") == 10_000_000.0
    skew = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.exp(F.col("id") / 20_000)).alias("v"))
    values = sorted(r.v for r in skew.collect())
    assert P.fit_median(skew, "v") == values[(len(values) + 1) // 2 - 1]
    odd = spark.createDataFrame([(float("nan"),), (None,), (3.0,), (1.0,)], "v double")
    assert P.fit_median(odd, "v") == 1.0 and P.fit_median(odd.limit(0), "v") is None
    assert P.fit_null_policy(skew, median=["v"]).values == {"v": values[(len(values) + 1) // 2 - 1]}


def test_metrics_keep_the_null_group(spark):
    rows = [(f, y, p, s) for f in (None, "a") for y, p, s in ((1, 1, 0.9), (0, 0, 0.2), (1, 0, 0.4), (0, 1, 0.6))]
    m = {r.fold: r for r in E.classification_metrics(spark.createDataFrame(rows, "fold string, y int, p int, s double"), "y", "p", "s", by="fold").collect()}
    assert set(m) == {None, "a"} and m[None].roc_auc == m["a"].roc_auc == 0.75


def test_zone_lookup_keeps_rows_that_share_a_key(spark):
    pts = spark.createDataFrame([(1, 10.0, 10.0, "p"), (1, 50.0, 50.0, "q"), (None, 10.0, 10.0, "r"), (None, None, 3.0, "s"), (2, 10.0, 10.0, "t")], "k int, lat double, lon double, tag string")
    zones = spark.createDataFrame([("z1", 11.0, 10.0, "A"), ("z2", 49.0, 50.0, "B")], "zone_id string, zone_lat double, zone_lon double, zone string")
    got = {r.tag: r.zone for r in J.zone_lookup(pts, zones, "k", "lat", "lon").collect()}
    assert got == {"p": "A", "q": "B", "r": "A", "s": None, "t": "A"}


def test_joins_leave_the_choice_to_the_planner(spark, small_dir):
    """No eager count and no single-partition limit when a dimension is joined."""
    big = spark.range(5_000_000).withColumnRenamed("id", "k")
    plan = J.inner_enrich(spark.range(10).withColumnRenamed("id", "k"), big, "k")._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "SinglePartition" not in plan
