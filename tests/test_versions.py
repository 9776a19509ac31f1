"""Committed stage versions, ordered output, scratch removal, reloading by class, and the
check of a trained model."""

import math
import os

import pytest
from pyspark.sql import functions as F

from eventfeat.operators.features import fit_scaler
from eventfeat.operators.train import spread_rows, train_mlp, training_loss
from eventfeat.sources import io as IO


def _local(path):
    return path.removeprefix("file:")


def _rows(spark, root):
    return sorted(r[0] for r in spark.read.parquet(IO.current_version(spark, root)).collect())


def _failing(df):
    def fail(batches):
        for b in batches:
            yield b
            raise RuntimeError("lost in the middle")

    return df.mapInArrow(fail, df.schema)


def test_a_failed_write_leaves_the_former_version(spark):
    root = IO.scratch_path(spark, "commit")
    IO.write_version(spark.range(5), root)
    with pytest.raises(Exception, match="lost in the middle"):
        IO.write_version(_failing(spark.range(100, 200)), root)
    assert _rows(spark, root) == [0, 1, 2, 3, 4]
    assert IO.read_stage(spark, os.path.dirname(root), os.path.basename(root)).count() == 5
    IO.write_version(spark.range(7), root)
    assert len(_rows(spark, root)) == 7


def test_a_half_written_version_is_never_read(spark):
    root = IO.scratch_path(spark, "half")
    spark.range(3).write.parquet(f"{root}/v000000-half")            # a writer that died before its commit
    IO.write_version(spark.range(2), root)
    os.makedirs(_local(f"{root}/_commits"), exist_ok=True)
    open(_local(f"{root}/_commits/_000000009"), "w").close()          # one that died while committing
    assert _rows(spark, root) == [0, 1]
    IO.write_version(spark.range(4), root)
    assert _rows(spark, root) == [0, 1, 2, 3] and len(IO.commits(spark, root)) == 2
    assert os.path.exists(_local(f"{root}/v000000-half"))            # too young to be called abandoned
    assert IO.remove_versions(spark, root, abandoned_s=-5) == ["v000000-half"] and _rows(spark, root) == [0, 1, 2, 3]


def test_old_versions_go_by_rule(spark):
    root = IO.scratch_path(spark, "old")
    paths = [IO.write_version(spark.range(n), root, keep=2) for n in (1, 2, 3, 4)]
    assert [os.path.exists(_local(p)) for p in paths] == [False, False, True, True]
    assert len(IO.commits(spark, root)) == 2 and len(_rows(spark, root)) == 4
    numbers = sorted(n.split(".")[0] for n in os.listdir(_local(f"{root}/_commits")) if not n.startswith((".", "_")))
    assert numbers == ["000000002", "000000003"]                     # numbers are never used again


def test_two_writers_of_one_number(spark):
    root = IO.scratch_path(spark, "two")
    IO.write_version(spark.range(1), root)
    fs, p = IO._fs(spark, f"{root}/_commits/_000000001")
    fs.create(p, False).close()
    with pytest.raises(Exception):
        fs.create(p, False)


def test_partitioned_version_and_plain_stage(spark):
    root = IO.scratch_path(spark, "parts")
    df = spark.range(10).selectExpr("id", "id % 2 AS split")
    IO.write_stage(df, root, partition_by=["split"])
    assert IO.current_version(spark, root) == root and IO.read_partition(spark, root, split=1).count() == 5
    other = IO.scratch_path(spark, "parts2")
    IO.write_version(df, other, partition_by=["split"])
    assert IO.read_partition(spark, other, split=0).count() == 5


@pytest.mark.parametrize("files", [1, 7])
def test_ordered_output_has_one_order_over_all_files(spark, files):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 97 END AS v")
    path = IO.write_ordered(df, IO.scratch_path(spark, "ordered"), [F.col("v").desc(), F.col("id")], files)
    got = sorted((r["position"], r["v"], r["id"]) for r in IO.read_ordered(spark, path).collect())
    want = sorted(((r["v"], r["id"]) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert got == [(k, v, i) for k, (v, i) in enumerate(want)]
    assert len([f for f in os.listdir(_local(path)) if f.endswith(".parquet")]) == files


def test_remove_scratch_takes_only_its_application(spark):
    base = os.path.dirname(_local(IO.scratch_path(spark, "x")))
    own = f"{base}/eventfeat-app-test-1-a-0123"
    spark.range(1).write.parquet(own)
    kept = IO.write_stage(spark.range(1), IO.scratch_path(spark, "kept"))
    assert IO.remove_scratch(spark, "app-test-1") == [os.path.basename(own)]
    assert not os.path.exists(own) and spark.read.parquet(kept).count() == 1


def test_reload_by_class_and_real_errors(spark):
    df = spark.range(20).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 2 AS DOUBLE) AS y")
    path = IO.scratch_path(spark, "model")
    model = fit_scaler(df, ["x"])
    IO.save_model(model, f"{path}/pipeline")
    IO.save_model(model.stages[1], f"{path}/single")
    assert type(IO.load_model(f"{path}/pipeline")).__name__ == "PipelineModel"
    assert type(IO.load_model(f"{path}/single")).__name__ == "StandardScalerModel"
    with pytest.raises(Exception, match="(?i)not.*exist"):
        IO.load_model(f"{path}/missing")


def test_training_loss_equals_a_plain_computation(spark):
    df = spark.range(200).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(id % 17 > 8 OR id % 11 = 0 AS DOUBLE) AS y")
    tr = fit_scaler(df, ["a", "b"]).transform(df)
    for hidden, bound in (((), 1e-3), ((3,), 0.05)):
        model = train_mlp(tr, "scaled", "y", hidden=hidden, tol=1e-9, max_iter=200)
        got = training_loss(model, tr, "scaled", "y").first()
        rows = model.transform(tr).select("probability", "y", "scaled").collect()
        p = [r["probability"][1] for r in rows]
        assert got["rows"] == 200 and got["loss"] == pytest.approx(-sum(math.log(q if r["y"] else 1 - q) for q, r in zip(p, rows)) / 200)
        slopes = [abs(sum((q - r["y"]) * x(r) for q, r in zip(p, rows)) / 200) for x in (lambda r: 1, lambda r: r["scaled"][0], lambda r: r["scaled"][1])]
        assert got["gradient"] == pytest.approx(max(slopes) if not hidden else slopes[0]) and got["gradient"] < bound
    early = training_loss(train_mlp(tr, "scaled", "y", hidden=(), max_iter=1), tr, "scaled", "y").first()
    assert early["gradient"] > 1e-3  # one step is no optimum


def test_training_is_dealt_over_tasks(spark):
    df = spark.range(20_000).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 17 > 8 OR id % 11 = 0 AS DOUBLE) AS y").coalesce(1)
    tr = fit_scaler(df, ["a"]).transform(df)
    sc = spark.sparkContext
    sc.setJobGroup("training-tasks", "tasks of a training run on one partition")
    try:
        model = train_mlp(tr, "scaled", "y", hidden=(2,), max_iter=4)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("training-tasks") for s in tracker.getJobInfo(j).stageIds]
    assert sum(s is not None and s.numTasks == 3 for s in stages) >= 4  # each iteration at least
    assert training_loss(model, tr, "scaled", "y").first()["rows"] == 20_000
    assert sorted(r["a"] for r in spread_rows(tr).select("a").collect()) == sorted(r["a"] for r in tr.select("a").collect())
