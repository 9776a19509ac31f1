"""Queries for scans and sinks (S1, S2, S4-S7, S9): write to a fresh folder under
the shared checkpoint directory, read back, and compare with the source table."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventfeat.operators.split import assign_folds, rolling_windows
from eventfeat.plans.fixtures import fixture, with_fixtures
from eventfeat.plans.registry import register
from eventfeat.plans.tables import Tables
from eventfeat.sources import io as IO


@register("s1_read_stage", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def q_s1(spark, d):
    root = IO.scratch_path(spark, "run")
    src = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    IO.write_stage(src, IO.stage_path(root, "final_join", "3m"))
    return IO.read_stage(spark, root, "final_join", "3m")


@register("s2_read_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_s2(spark, d):
    p = IO.scratch_path(spark, "csv")
    Tables(spark, d).customer.write.mode("overwrite").option("header", True).csv(p)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return IO.read_csv(spark, p, schema)


def _splits(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return {"train": o.filter(F.col("o_orderdate") < cut), "test": o.filter(F.col("o_orderdate") >= cut)}


@register("s4_read_partition", "SELECT o_orderkey, o_orderdate, 'train' AS split FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'")
def q_s4(spark, d):
    p = IO.write_splits(_splits(spark, d), IO.scratch_path(spark, "train_test"))
    return IO.read_partition(spark, p, split="train")


@register("s4_list_folds", """
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1
              FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     f AS (SELECT CAST(k + 1 AS INTEGER) AS fold, CAST(d0 + to_months(CAST(24 + 12 * k AS INTEGER)) + to_months(12) AS DATE) AS val_end,
                  CAST(d1 + 1 AS DATE) AS lim FROM span, (SELECT unnest(range(0, date_diff('month', d0, d1) // 12 + 3)) AS k FROM span))
SELECT fold FROM f WHERE val_end <= lim""")
def q_s4f(spark, d):
    o = Tables(spark, d).orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderdate")
    tagged = assign_folds(o, "o_orderdate", rolling_windows(o, "o_orderdate", 24, 12, 12))
    p = IO.write_stage(tagged, IO.scratch_path(spark, "rolling_windows"), partition_by=["fold", "role"])
    return IO.list_folds(spark.read.parquet(p), "fold")


@register("s5_write_stage", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def q_s5(spark, d):
    p = IO.write_stage(Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"),
                       IO.scratch_path(spark, "stage"))
    return spark.read.parquet(p)


@register("s5_write_version", "SELECT o_orderkey, o_totalprice FROM orders")
def q_s5v(spark, d):
    """The second version of a stage, read through its commit log."""
    src, p = Tables(spark, d).orders.select("o_orderkey", "o_totalprice"), IO.scratch_path(spark, "versions")
    IO.write_version(src.withColumn("o_totalprice", F.col("o_totalprice") + 1), p)
    IO.write_version(src, p)
    return spark.read.parquet(IO.current_version(spark, p))


@register("o1_ordered_output", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders")
def q_o1(spark, d):
    src, p = Tables(spark, d).orders.select("o_orderkey", "o_totalprice"), IO.scratch_path(spark, "ordered")
    return IO.read_ordered(spark, IO.write_ordered(src, p, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 6))


@register("s6_write_repartitioned", "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders")
def q_s6(spark, d):
    src = Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    p = IO.write_stage(src, IO.scratch_path(spark, "repart"), n=4, keys=["o_orderdate", "o_orderpriority"])
    return spark.read.parquet(p)


@register("s7_write_splits", """
SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS split FROM orders""")
def q_s7(spark, d):
    p = IO.write_splits(_splits(spark, d), IO.scratch_path(spark, "splits"))
    return spark.read.parquet(p)


_WIDE_SQL = ("SELECT fold, step, floor(avg(is_f) * 2 * 100 + 0.5) / 100 AS val_pr_auc, "
             "floor(avg(is_fo) * 100 + 0.5) / 100 AS train_pr_auc FROM orders_metrics GROUP BY fold, step")


@register("s9_metric_log", with_fixtures(f"""
WITH w AS ({_WIDE_SQL}),
     l AS (SELECT fold, step, 'val_pr_auc' AS name, val_pr_auc AS value FROM w
           UNION ALL SELECT fold, step, 'train_pr_auc', train_pr_auc FROM w),
     b AS (SELECT *, row_number() OVER (PARTITION BY fold, name ORDER BY step DESC) AS rn FROM l)
SELECT 'run-1' AS run_id, fold, name, step, value FROM b WHERE rn = 1""", "orders_metrics"))
def q_s9(spark, d):
    m = fixture(spark, d, "orders_metrics")
    wide = m.groupBy("fold", "step").agg((F.floor(F.avg("is_f") * 2 * 100 + 0.5) / 100).alias("val_pr_auc"),
                                         (F.floor(F.avg("is_fo") * 100 + 0.5) / 100).alias("train_pr_auc"))
    p = IO.scratch_path(spark, "metrics")
    IO.log_metrics(wide, p, "run-1")
    return IO.latest_metrics(IO.metric_history(spark, p)).select("run_id", "fold", "name", "step", "value")
