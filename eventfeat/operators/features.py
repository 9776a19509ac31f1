"""Spark ML feature pipeline.

Fitting is distributed (StringIndexer counts values with an aggregate, the scaler
uses a summarizer tree-aggregate); only the fitted labels/means reach the driver.
One assembler + one scaler replaces per-column scaler stages (same numbers, far
fewer stages); per-column scalars come back with ``vector_to_array``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_index(train: DataFrame, cols: Sequence[str], suffix: str = "_idx") -> PipelineModel:
    """Frequency-ordered category index per column (ties alphabetical);
    unseen and NULL values get the extra index ``len(labels)``."""
    cols = list(cols)
    return Pipeline(stages=[StringIndexer(inputCols=cols, outputCols=[f"{c}{suffix}" for c in cols], handleInvalid="keep",
                                          stringOrderType="frequencyDesc")]).fit(train)


def cardinalities(model: PipelineModel) -> list[tuple[str, int]]:
    """(column, number of labels + 1 for unknown) from fitted indexers."""
    out = []
    for st in model.stages:
        if hasattr(st, "labelsArray"):
            ins = st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]
            out += [(c, len(labels) + 1) for c, labels in zip(ins, st.labelsArray)]
    return out


@dataclass
class FeatureSpec:
    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    binary: Sequence[str] = ()
    log_cols: Sequence[str] = ()        # numeric columns replaced by their *_log version
    log_suffix: str = "_log"
    with_mean: bool = True


def feature_pipeline(spec: FeatureSpec) -> Pipeline:
    """Index + one-hot per categorical, numeric vector (logs replacing the
    raw columns, sorted), standardised copy, and three final vectors:
    ``log_scaled_features`` (scaled numeric + one-hot + binary),
    ``log_unscaled_features`` (unscaled numeric + ...), ``full_unscaled_features``
    (raw numeric, no logs + ...).  NULL numerics become NaN (handleInvalid keep)."""
    logs = set(spec.log_cols)
    num = sorted([c for c in spec.numeric if c not in logs] + [f"{c}{spec.log_suffix}" for c in spec.log_cols])
    raw_sorted = sorted(spec.numeric)
    stages = []
    ohe = [f"{c}_ohe" for c in spec.categorical]
    if spec.categorical:
        # one multi-column indexer and one encoder: a single counting pass for all
        # categorical columns instead of one pass (and one plan layer) per column
        idx = [f"{c}_idx" for c in spec.categorical]
        stages.append(StringIndexer(inputCols=list(spec.categorical), outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe))
    stages.append(VectorAssembler(inputCols=num, outputCol="numbers", handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="numbers", outputCol="numbers_scaled", withStd=True, withMean=spec.with_mean))
    tail = list(spec.binary)
    if ohe:
        stages.append(VectorAssembler(inputCols=ohe, outputCol="one_hot", handleInvalid="keep"))
        tail = ["one_hot", *tail]
    stages.append(VectorAssembler(inputCols=["numbers_scaled", *tail], outputCol="log_scaled_features", handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=["numbers", *tail], outputCol="log_unscaled_features", handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*raw_sorted, *tail], outputCol="full_unscaled_features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def fit_scaler(train: DataFrame, cols: Sequence[str], with_mean: bool = True, out: str = "scaled") -> PipelineModel:
    """One assembler + StandardScaler (sample std) over ``cols``."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol="_vec", handleInvalid="keep"),
        StandardScaler(inputCol="_vec", outputCol=out, withStd=True, withMean=with_mean),
    ]).fit(train)


def scaled_columns(df: DataFrame, vec: str, names: Sequence[str], suffix: str = "_num") -> DataFrame:
    """Split a vector back into named double columns (``vector_to_array``)."""
    arr = vector_to_array(F.col(vec))
    return df.withColumns({f"{n}{suffix}": arr[i] for i, n in enumerate(names)})


def to_model_columns(df: DataFrame, num_vec: str | None, num: Sequence[str], cat_idx: Sequence[str],
                     binary: Sequence[str], y: str) -> DataFrame:
    """Flat typed model input: ``<c>_num`` doubles (from the scaled vector, or the
    raw columns when ``num_vec`` is None), ``<c>_cat`` ints (category index),
    ``<c>_bin`` floats and ``target`` float."""
    if num_vec:
        arr = vector_to_array(F.col(num_vec))
        nums = [arr[i].cast("double").alias(f"{c}_num") for i, c in enumerate(num)]
    else:
        nums = [F.col(c).cast("double").alias(f"{c}_num") for c in num]
    cats = [F.col(f"{c}_idx").cast("int").alias(f"{c}_cat") for c in cat_idx]
    bins = [F.col(c).cast("float").alias(f"{c}_bin") for c in binary]
    return df.select(*nums, *cats, *bins, F.col(y).cast("float").alias("target"))


def ohe_positions(df: DataFrame, vec: str, out_size: str = "ohe_size", out_index: str = "ohe_index") -> DataFrame:
    """E2 check helper: size of a one-hot vector and the position of its 1 (NULL if
    all zero)."""
    arr = vector_to_array(F.col(vec))
    pos = F.array_position(arr, F.lit(1.0))
    return df.withColumns({out_size: F.size(arr), out_index: F.when(pos > 0, (pos - 1).cast("int"))})
