"""Incremental stage runner (foreachBatch) and the sink/source helpers."""

import os
import tempfile

from pyspark.sql import functions as F

from eventfeat.sources import io as IO
from eventfeat.streaming import stage_stream


def test_stage_stream_appends_transformed_batches(spark, small_dir):
    root = tempfile.mkdtemp(prefix="eventfeat-stream-", dir="/tmp")
    src, sink, ck = (os.path.join(root, x) for x in ("src", "sink", "ck"))
    ev = spark.read.parquet(f"{small_dir}/events.parquet")
    ev.filter(F.col("event_id") % 2 == 0).write.parquet(src)
    fn = lambda b: b.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    q = stage_stream(spark, src, ev.schema, fn, sink, ck)
    q.awaitTermination(120)
    first = spark.read.parquet(sink).agg(F.sum("n")).first()[0]
    assert first == ev.filter(F.col("event_id") % 2 == 0).count()
    # a second run only sees the new files
    ev.filter(F.col("event_id") % 2 == 1).write.mode("append").parquet(src)
    q = stage_stream(spark, src, ev.schema, fn, sink, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(sink).agg(F.sum("n")).first()[0] == ev.count()


def test_stage_path_validates_horizon():
    assert IO.stage_path("/x/run", "final_join", "3m") == "/x/run_3m/final_join"
    assert IO.stage_path("/x/run", "final_join", "all") == "/x/run/final_join"
    try:
        IO.stage_path("/x/run", "final_join", "2m")
    except ValueError:
        pass
    else:
        raise AssertionError("bad horizon accepted")


def test_metric_log_appends(spark):
    p = IO.scratch_path(spark, "mlog")
    wide = spark.createDataFrame([(1, 1, 0.5, 0.6), (1, 2, 0.55, 0.7)], "fold int, step int, val double, tr double")
    IO.log_metrics(wide, p, "r1")
    IO.log_metrics(wide.withColumn("step", F.col("step") + 2), p, "r1")
    hist = IO.metric_history(spark, p, "val")
    assert hist.count() == 4
    last = {r["name"]: (r["step"], r["value"]) for r in IO.latest_metrics(IO.metric_history(spark, p)).collect()}
    assert last == {"val": (4, 0.55), "tr": (4, 0.7)}
