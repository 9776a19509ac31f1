"""All folds in one pass against one feature pipeline per fold."""

import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eventfeat.operators import features as FE
from eventfeat.operators import profile as P
from eventfeat.operators import split as V
from eventfeat.operators.folds import fit_folds, process_folds

SPEC = FE.FeatureSpec(numeric=["dist", "wind", "whole", "same"], categorical=["carrier", "month"], binary=["flag"])
VECTORS = ["numbers", "numbers_scaled", "log_scaled_features", "log_unscaled_features", "full_unscaled_features"]


@pytest.fixture(scope="module")
def windows(spark):
    rng, rows = random.Random(4), []
    for fold in (1, 2, 3):
        for role in ("train", "val"):
            for k in range(120 if role == "train" else 40):
                dist = rng.expovariate(1) * 500 if fold != 2 else rng.uniform(0, 10)  # skewed in folds 1 and 3 only
                rows.append((fold, role, f"{fold}{role}{k}", dist, rng.gauss(0, 4), rng.randint(0, 9), 5.0, rng.choice("ABCD" if role == "train" else "ABCDEF"),
                             rng.choice([1, 1, 2, 2, 3, None]), rng.choice([0, 1, None]), int(rng.random() < 0.2)))
    rows.append((4, "val", "alone", 1.0, 1.0, 1, 5.0, "A", 1, 0, 1))  # a fold without training rows
    df = spark.createDataFrame(rows, "fold int, role string, id string, dist double, wind double, whole int, same double, carrier string, "
                                     "month int, flag int, y int")
    path = f"{V.__name__}-windows"
    from eventfeat.sources import io as IO
    return spark.read.parquet(IO.write_stage(df, IO.scratch_path(spark, path), partition_by=["fold", "role"]))


def as_rows(df, cols):
    return {r["id"]: r for r in df.select("id", *[vector_to_array(c).alias(c) for c in cols]).collect()}


def close(a, b):
    return len(a) == len(b) and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))


@pytest.mark.parametrize("ratio", [None, 2.0])
def test_equal_to_the_loop_over_folds(windows, ratio):
    done, fits = process_folds(windows, SPEC, ["dist", "wind"], target="y", key="id", downsample_ratio=ratio)
    assert sorted(fits) == [1, 2, 3] and [fits[k].log_cols for k in (1, 2, 3)] == [["dist"], [], ["dist"]]
    assert fits[1].rows == 120 and done.filter("fold = 4").count() == 0
    for fold in (1, 2, 3):
        part = P.flags_to_double(windows.filter(F.col("fold") == fold), ["flag"])
        train = part.filter("role = 'train'")
        skew = P.fit_skew_log(train, ["dist", "wind"])
        spec = FE.FeatureSpec(numeric=SPEC.numeric, categorical=SPEC.categorical, binary=SPEC.binary, log_cols=skew.cols)
        model = FE.feature_pipeline(spec).fit(skew.apply(train))
        for role in ("train", "val"):
            want = model.transform(skew.apply(part.filter(F.col("role") == role)))
            if role == "train" and ratio:
                want = V.downsample(want, "y", "id", target_ratio=ratio)
            want, got = as_rows(want, VECTORS), as_rows(done.filter((F.col("fold") == fold) & (F.col("role") == role)), VECTORS)
            assert set(got) == set(want) and (role == "val" or ratio is None or len(got) < 120)
            assert all(close(got[k][c], want[k][c]) for k in want for c in VECTORS)


def test_null_numbers_give_nan_statistics_as_the_scaler(spark):
    rows = [(1, "train", str(k), None if k == 3 else float(k), 0) for k in range(8)]
    df = spark.createDataFrame(rows, "fold int, role string, id string, x double, y int")
    done, fits = process_folds(df, FE.FeatureSpec(numeric=["x"]))
    assert math.isnan(fits[1].moments["x"][0])
    assert all(math.isnan(r["numbers_scaled"][0]) for r in as_rows(done, ["numbers_scaled"]).values())


def test_labels_in_order_of_count_then_name(windows):
    fits = fit_folds(windows.filter("role = 'train'"), SPEC, target="y")
    for fold, fit in fits.items():
        model = FE.fit_index(windows.filter((F.col("fold") == fold) & (F.col("role") == "train")), ["carrier", "month"])
        assert [fit.labels["carrier"], fit.labels["month"]] == [list(x) for x in model.stages[0].labelsArray]


def test_statistics_take_two_jobs_for_any_number_of_folds(spark, windows):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fit-folds", "statistics of all folds")
    fit_folds(windows.filter("role = 'train'"), SPEC, ["dist", "wind"], target="y")
    jobs = tracker.getJobIdsForGroup("fit-folds")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = sum(len(tracker.getJobInfo(j).stageIds) for j in jobs)
    assert len(jobs) <= 4 and stages <= 6  # an aggregate is two jobs where AQE runs its stages apart


def test_no_training_rows(windows):
    done, fits = process_folds(windows.filter("role = 'val'"), SPEC, ["dist"])
    assert fits == {} and done.count() == 0
