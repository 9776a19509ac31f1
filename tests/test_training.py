"""The trainer against the library's: the same course where both weigh rows alike, rows of
equal weight where they don't, its refusals, and its time."""

import math
import time

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from eventfeat.operators import train as T
from eventfeat.operators.features import fit_scaler
from eventfeat.operators.lbfgs import minimize
from eventfeat.sources import io as IO


def _rows(spark, n, parts=1, classes=2):
    df = spark.range(0, n, 1, parts).selectExpr("CAST(id * 37 % 101 AS DOUBLE) AS a", "CAST(id * 53 % 89 AS DOUBLE) AS b",
                                                f"(id * 37 % 101 + id * 53 % 89 + id % 7 * 20) % {97 * classes} div 97 AS y")
    return fit_scaler(df, ["a", "b"]).transform(df)


@pytest.mark.parametrize("hidden,classes", [((), 2), ((5,), 2), ((6, 4), 3)])
def test_same_course_as_the_library(spark, hidden, classes):
    tr = _rows(spark, 1280, classes=classes)                            # whole blocks of one partition
    got = T.train_mlp(tr, "scaled", "y", hidden=hidden, n_classes=classes, max_iter=25)
    want = MultilayerPerceptronClassifier(featuresCol="scaled", labelCol="y", layers=[2, *hidden, classes], maxIter=25, seed=T.SEED, tol=T.TOL, stepSize=0.01).fit(tr)
    a, b = got.summary().objectiveHistory, want.summary().objectiveHistory
    assert len(a) == len(b) and a == pytest.approx(b, rel=1e-6) and a[-1] < a[0]
    assert got.weights.toArray() == pytest.approx(want.weights.toArray(), rel=1e-3, abs=1e-3)
    assert got.summary().accuracy == pytest.approx(want.summary().accuracy, abs=2e-3)
    for p in ("maxIter", "seed", "tol", "blockSize", "stepSize", "layers", "featuresCol", "labelCol", "solver"):
        assert got.getOrDefault(p) == want.getOrDefault(p)


def test_every_row_counts_the_same(spark):
    tr = _rows(spark, 1300)                                             # the last block of 128 has 20 rows
    one, many = (T.train_mlp(df, "scaled", "y", hidden=(4,), block_size=b, max_iter=10) for df, b in ((tr, 1), (tr.repartition(7), 128)))
    assert one.weights.toArray() == pytest.approx(many.weights.toArray(), rel=1e-6, abs=1e-8)
    assert many.summary().objectiveHistory[-1] == pytest.approx(T.training_loss(many, tr, "scaled", "y").first()["loss"], rel=1e-9)


def test_gradient_is_the_slope_of_the_loss(spark):
    rng, layers = np.random.default_rng(1), [3, 5, 4, 3]
    block = rng.standard_normal((5, T.CHUNK_ROWS + 9))
    block[-2], block[-1] = 1, rng.integers(0, 3, block.shape[1])
    w = rng.standard_normal(sum((a + 1) * b for a, b in zip(layers, layers[1:])))
    at = lambda v: next(T._sums(layers, v)([block.tobytes()]))
    got = at(w)
    assert got[1] == block.shape[1]
    for k in range(len(w)):
        d = np.zeros_like(w)
        d[k] = 1e-6
        assert got[2 + k] == pytest.approx((at(w + d)[0] - at(w - d)[0]) / 2e-6, rel=1e-4, abs=1e-4)
    w[:15] *= 1e4                                                       # sums beyond exp's range
    assert np.isfinite(at(w)).all()


@pytest.mark.parametrize("label,vector,says", [("2.0", "array(1D, 2D)", "Labels"), ("0.5", "array(1D, 2D)", "Labels"), ("NULL", "array(1D, 2D)", "Labels"),
                                               ("1.0", "array(1D, double('NaN'))", "NaN or Infinity"), ("1.0", "array(1D)", "2 values"), ("1.0", "NULL", "(?i)null")])
def test_refuses_what_the_library_refuses(spark, label, vector, says):
    df = spark.sql(f"SELECT array(0D, 1D) AS v, 0D AS y UNION ALL SELECT {vector}, CAST({label} AS DOUBLE)").select(F.when(F.col("v").isNotNull(), T.array_to_vector("v")).alias("x"), "y")
    with pytest.raises(Exception, match=says):
        T.train_mlp(df, "x", "y", hidden=(2,), max_iter=2, input_dim=2)


def test_no_iterations_and_reloading(spark):
    tr = _rows(spark, 300)
    start = T.train_mlp(tr, "scaled", "y", hidden=(3,), max_iter=0)
    want = MultilayerPerceptronClassifier(featuresCol="scaled", labelCol="y", layers=[2, 3, 2], maxIter=0, seed=T.SEED).fit(tr)
    assert start.weights == want.weights
    path = IO.scratch_path(spark, "trained")
    IO.save_model(start, path)
    again = IO.load_model(path)
    assert type(again) is MultilayerPerceptronClassificationModel and again.weights == start.weights and again.getMaxIter() == 0


def test_minimize_ends():
    bowl = lambda x: (float(x @ x), 2 * x)
    x, values = minimize(bowl, np.array([3.0, -4.0]), 50, 1e-9)
    assert abs(x).max() < 1e-6 and len(values) < 10 and values[0] == 25
    nothing = lambda x: (math.nan, x * math.nan)
    x, values = minimize(nothing, np.ones(2), 50, 1e-9)
    assert (x == 1).all() and len(values) == 3                         # no step, nor without corrections


def test_wide_sums_meet_in_a_tree_first(spark, monkeypatch):
    tr = _rows(spark, 900).repartition(9)
    flat = T.train_mlp(tr, "scaled", "y", hidden=(3,), max_iter=4)
    monkeypatch.setattr(T, "DRIVER_BYTES", 0)
    assert T.train_mlp(tr, "scaled", "y", hidden=(3,), max_iter=4).weights.toArray() == pytest.approx(flat.weights.toArray(), rel=1e-9)


def test_passes_take_a_part_of_the_librarys_time(spark):
    tr = _rows(spark, 150_000, parts=4).persist()
    tr.count()

    def took(fit):
        began = time.time()
        fit()
        return time.time() - began

    lib = MultilayerPerceptronClassifier(featuresCol="scaled", labelCol="y", layers=[2, 128, 64, 2], maxIter=6, seed=T.SEED)
    want = took(lambda: lib.fit(tr.select("scaled", F.col("y").cast("double"))))
    assert took(lambda: T.train_mlp(tr, "scaled", "y", max_iter=6)) < want / 2
    tr.unpersist()
