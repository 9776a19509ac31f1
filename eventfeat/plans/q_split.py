"""Queries for splits, folds and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventfeat.operators import split as V
from eventfeat.plans.registry import register
from eventfeat.plans.tables import Tables

_TRAIN_END = "1999-01-01"


@register("v1_horizon_split", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' THEN 'train'
                        WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' THEN 'test' END AS split
FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'""")
def q_v1(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return V.horizon_split(o, "o_orderdate", "1995-01-01", 48, 12).select("o_orderkey", "split")


def _train(spark, d):
    o = Tables(spark, d).orders
    return o.filter(F.col("o_orderdate") < F.lit(_TRAIN_END).cast("timestamp_ntz"))


_FOLDS_SQL = """
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1
              FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     k AS (SELECT unnest(range(0, date_diff('month', d0, d1) // 12 + 3)) AS k FROM span),
     f AS (SELECT CAST(k + 1 AS INTEGER) AS fold,
                  CAST(d0 + to_months(CAST(24 + 12 * k AS INTEGER)) - to_months(24) AS DATE) AS train_start,
                  CAST(d0 + to_months(CAST(24 + 12 * k AS INTEGER)) AS DATE) AS val_start,
                  CAST(d0 + to_months(CAST(24 + 12 * k AS INTEGER)) + to_months(12) AS DATE) AS val_end,
                  CAST(d1 + 1 AS DATE) AS lim FROM span, k)
SELECT fold, train_start, val_start, val_end FROM f WHERE val_end <= lim"""


@register("v2_rolling_windows", _FOLDS_SQL)
def q_v2(spark, d):
    return V.rolling_windows(_train(spark, d), "o_orderdate", 24, 12, 12)


@register("v3_assign_folds", f"""
WITH folds AS ({_FOLDS_SQL})
SELECT o_orderkey, fold, CASE WHEN o_orderdate < CAST(val_start AS TIMESTAMP) THEN 'train' ELSE 'val' END AS role
FROM orders JOIN folds ON o_orderdate >= CAST(train_start AS TIMESTAMP) AND o_orderdate < CAST(val_end AS TIMESTAMP)
WHERE o_orderdate < TIMESTAMP '1999-01-01'""")
def q_v3(spark, d):
    tr = _train(spark, d).select("o_orderkey", "o_orderdate")
    folds = V.rolling_windows(tr, "o_orderdate", 24, 12, 12)
    return V.assign_folds(tr, "o_orderdate", folds).select("o_orderkey", "fold", "role")


@register("v4_year_split", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1995 AND 1998 THEN 'train'
                        WHEN year(o_orderdate) = 1999 THEN 'val' WHEN year(o_orderdate) = 2000 THEN 'test' END AS split
FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2000""")
def q_v4(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return V.year_split(o, "o_orderdate", {"train": range(1995, 1999), "val": [1999], "test": [2000]}).select("o_orderkey", "split")


_HASH = "(CAST(('0x' || substr(md5('42:' || CAST(o_orderkey AS STRING)), 1, 8)) AS BIGINT) / 4294967296.0)"


@register("v6_downsample", f"""
WITH c AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS pos, count(*) FILTER (WHERE o_orderstatus <> 'F') AS neg FROM orders)
SELECT o_orderkey, o_orderstatus FROM orders, c
WHERE o_orderstatus = 'F' OR {_HASH} < (CAST(pos AS DOUBLE) / neg) / 1.0""")
def q_v6(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    return V.downsample(o, "y", "o_orderkey", target_ratio=1.0, seed=42).select("o_orderkey", "o_orderstatus")


@register("v7_hash_sample", f"SELECT o_orderkey FROM orders WHERE {_HASH} < 0.1")
def q_v7(spark, d):
    return V.hash_sample(Tables(spark, d).orders.select("o_orderkey"), 0.1, "o_orderkey", seed=42)


@register("u1_tagged_union", """
SELECT o_orderkey, 'train' AS split FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT o_orderkey, 'test' AS split FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def q_u1(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    cut = F.lit(_TRAIN_END).cast("timestamp_ntz")
    return V.tagged_union({"train": o.filter(F.col("o_orderdate") < cut).select("o_orderkey"),
                           "test": o.filter(F.col("o_orderdate") >= cut).select("o_orderkey")})
