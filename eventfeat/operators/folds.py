"""Fold processing in one pass (E1-E6, X9, V6 for all folds together).

Fold-tagged rows are read once for every statistic that the folds need: one grouped
aggregate has the moments of all numeric columns and of their signed logs and the class
counts, one grouped count has the category labels (the two read different columns).  Only
fitted values reach the driver: one row per fold, and the labels, as in Spark ML.  All
folds are then transformed and returned as one DataFrame, each fold read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventfeat.functions.numeric import signed_log
from eventfeat.operators.features import FeatureSpec
from eventfeat.operators.profile import flags_to_double
from eventfeat.operators.split import keep_majority


@dataclass
class FoldFit:
    """Statistics of one fold's training rows."""
    rows: int = 0
    positives: int = 0
    negatives: int = 0
    skews: dict[str, float | None] = field(default_factory=dict)
    log_cols: list[str] = field(default_factory=list)
    moments: dict[str, tuple[float, float]] = field(default_factory=dict)  # feature -> mean, sample deviation
    labels: dict[str, list[str]] = field(default_factory=dict)


def _values(c: str) -> Column:
    """A numeric column as the vectors hold it: NULL is NaN."""
    return F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))


def fit_folds(train: DataFrame, spec: FeatureSpec, log_candidates: Sequence[str] = (), skew_threshold: float = 1.0,
              target: str | None = None, fold: str = "fold") -> dict:
    """``{fold: FoldFit}`` of fold-tagged training rows.  ``spec.log_cols`` is ignored: the
    logs are chosen per fold, where |skewness| is above ``skew_threshold``."""
    logs = [c for c in log_candidates if c in train.columns]
    aggs = [F.count(F.lit(1)).alias("n")]
    if target is not None:
        aggs += [F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) == 0).alias("neg")]
    aggs += [F.skewness(F.col(c)).alias(f"s{i}") for i, c in enumerate(logs)]
    features = [(c, _values(c)) for c in spec.numeric] + [
        (f"{c}{spec.log_suffix}", F.coalesce(signed_log(c).cast("double"), F.lit(float("nan")))) for c in logs]
    for i, (_, v) in enumerate(features):
        aggs += [F.avg(v).alias(f"m{i}"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias(f"d{i}")]
    fits = {}
    for r in train.groupBy(fold).agg(*aggs).collect():  # one row per fold
        fit = fits[r[fold]] = FoldFit(r["n"], r["pos"] if target else 0, r["neg"] if target else 0)
        fit.skews = {c: r[f"s{i}"] for i, c in enumerate(logs)}
        fit.log_cols = [c for c in logs if fit.skews[c] is not None and abs(fit.skews[c]) > skew_threshold]
        fit.moments = {name: (r[f"m{i}"], r[f"d{i}"]) for i, (name, _) in enumerate(features)}
        fit.labels = {c: [] for c in spec.categorical}
    if spec.categorical:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(spec.categorical)]))
        counts = train.select(fold, pairs.alias("p")).filter("p.v IS NOT NULL").groupBy(fold, "p.i", "p.v").agg(F.count(F.lit(1)).alias("n"))
        found = sorted(counts.collect(), key=lambda r: (-r["n"], r["v"].encode("utf-16-be")))  # ties as Spark ML
        for r in found:
            fits[r[fold]].labels[spec.categorical[r["i"]]].append(r["v"])
    return fits


def transform_fold(df: DataFrame, spec: FeatureSpec, fit: FoldFit) -> DataFrame:
    """The vectors of ``features.feature_pipeline`` from one fold's statistics."""
    df = df.withColumns({f"{c}{spec.log_suffix}": signed_log(c) for c in fit.log_cols}) if fit.log_cols else df
    num = sorted([c for c in spec.numeric if c not in fit.log_cols] + [f"{c}{spec.log_suffix}" for c in fit.log_cols])

    def scaled(c):
        mean, dev = fit.moments[c]
        x = _values(c) - F.lit(mean) if spec.with_mean else _values(c)
        return x * F.lit(0.0 if dev == 0 else 1 / dev)

    df = df.withColumns({f"_scaled_{c}": scaled(c) for c in num})
    keep = {"handleInvalid": "keep"}
    ohe, stages = [f"{c}_ohe" for c in spec.categorical], []
    if spec.categorical:
        for c in spec.categorical:  # one model each: label arrays of unequal length are padded with nulls
            df = StringIndexerModel.from_labels(fit.labels[c], c, f"{c}_idx", "keep").transform(df)
        # sizes come from the index columns' metadata: no pass over the rows
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in spec.categorical], outputCols=ohe).fit(df))
    tail = list(spec.binary)
    stages += [VectorAssembler(inputCols=num, outputCol="numbers", **keep),
               VectorAssembler(inputCols=[f"_scaled_{c}" for c in num], outputCol="numbers_scaled", **keep)]
    if ohe:
        stages.append(VectorAssembler(inputCols=ohe, outputCol="one_hot", **keep))
        tail = ["one_hot", *tail]
    for name, first in (("log_scaled_features", ["numbers_scaled"]), ("log_unscaled_features", ["numbers"]),
                        ("full_unscaled_features", sorted(spec.numeric))):
        stages.append(VectorAssembler(inputCols=[*first, *tail], outputCol=name, **keep))
    return PipelineModel(stages).transform(df).drop(*[f"_scaled_{c}" for c in num])


def process_folds(windows: DataFrame, spec: FeatureSpec, log_candidates: Sequence[str] = (), skew_threshold: float = 1.0,
                  target: str | None = None, key: str | Column | None = None, downsample_ratio: float | None = None,
                  seed: int = 42, fold: str = "fold", role: str = "role", train_role: str = "train") -> tuple[DataFrame, dict]:
    """All folds of ``windows`` (rows tagged with ``fold`` and ``role``): statistics from the
    training rows, vectors for all rows, majority downsampling of the training rows when
    ``downsample_ratio`` is given (needs ``target`` and ``key``).  Returns the rows of all
    folds and ``{fold: FoldFit}``.

    A log column that only other folds have is NULL.  A fold without training rows is left
    out.  Written windows should be partitioned by fold: each branch then reads its own."""
    windows = flags_to_double(windows, list(spec.binary)) if spec.binary else windows
    fits = fit_folds(windows.filter(F.col(role) == train_role), spec, log_candidates, skew_threshold, target, fold)
    out = None
    for k, fit in sorted(fits.items()):
        part = windows.filter(F.col(fold) == F.lit(k))
        if downsample_ratio is not None:
            keep = keep_majority(target, key, fit.positives, fit.negatives, downsample_ratio, seed)
            part = part if keep is None else part.filter((F.col(role) != train_role) | keep)
        part = transform_fold(part, spec, fit)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return (windows.limit(0) if out is None else out), fits
