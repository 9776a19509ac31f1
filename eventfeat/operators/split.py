"""Time-ordered splits, rolling folds and reproducible sampling.

Folds are data (a small ``folds`` DataFrame), not driver loops: rows are tagged
with ``(fold, role)`` in one pass and written partitioned, so the source is read
once whatever the number of folds.  Sampling is a deterministic hash filter, so
the same rows are kept on any partitioning and in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfeat.functions.numeric import hash_unit

# --- fixed values: horizon presets (train months, test months) of the source pipeline
HORIZONS: dict[str, tuple[int, int]] = {"3m": (2, 1), "6m": (5, 1), "1y": (9, 3), "5y": (48, 12)}
# --- fixed values: rolling-fold presets (train months, validation months, step months)
ROLLING: dict[str, tuple[int, int, int]] = {"3m": (1, 1, 1), "6m": (2, 1, 1), "1y": (3, 1, 1), "5y": (24, 12, 12)}


def _lit_like(v, df: DataFrame, col: str) -> Column:
    return F.lit(v).cast(df.schema[col].dataType)


def horizon_split(df: DataFrame, ts: str, start, train_months: int, test_months: int,
                  out: str = "split", drop_outside: bool = True) -> DataFrame:
    """V1: ``train`` = [start, start+train), ``test`` = [start+train, start+train+test),
    one pass, one tag column (rows outside are dropped unless ``drop_outside=False``)."""
    s = F.to_date(F.lit(str(start)))
    t1 = F.add_months(s, train_months).cast(df.schema[ts].dataType)
    t2 = F.add_months(s, train_months + test_months).cast(df.schema[ts].dataType)
    s = s.cast(df.schema[ts].dataType)
    c = F.col(ts)
    tag = F.when((c >= s) & (c < t1), "train").when((c >= t1) & (c < t2), "test")
    out_df = df.withColumn(out, tag)
    return out_df.filter(F.col(out).isNotNull()) if drop_outside else out_df


def rolling_windows(df: DataFrame, ts: str, train_months: int, val_months: int, step_months: int) -> DataFrame:
    """V2: fold table ``fold, train_start, val_start, val_end`` (dates) from the data's
    own first/last day: validation starts at first + train, advances by ``step``;
    a fold is kept while ``val_end <= last day + 1``.  Computed in Spark with
    ``sequence`` + ``add_months`` (month ends clip like calendar arithmetic)."""
    span = df.agg(F.min(F.to_date(F.col(ts))).alias("d0"), F.max(F.to_date(F.col(ts))).alias("d1"))
    # the data's span in months bounds the number of folds
    last = F.ceil(F.months_between(F.col("d1"), F.col("d0")) / step_months).cast("int") + 1
    f = span.filter("d0 IS NOT NULL").select("d0", "d1", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    # the step is added to the previous validation start, so month-end clipping
    # accumulates exactly as repeated calendar-month addition does (Jan 31 -> Feb 28 -> Mar 28)
    vs = F.aggregate(F.array_repeat(F.lit(0), F.col("k").cast("int")), F.add_months(F.col("d0"), train_months),
                     lambda acc, _: F.add_months(acc, step_months))
    f = f.select(
        (F.col("k") + 1).cast("int").alias("fold"),
        F.add_months(vs, -train_months).alias("train_start"),
        vs.alias("val_start"),
        F.add_months(vs, val_months).alias("val_end"),
        F.date_add(F.col("d1"), 1).alias("_limit"))
    return f.filter(F.col("val_end") <= F.col("_limit")).drop("_limit")


def assign_folds(df: DataFrame, ts: str, folds: DataFrame, fold_col: str = "fold", role_col: str = "role") -> DataFrame:
    """V3: tag each row with every ``(fold, role)`` it belongs to: ``train`` if
    train_start <= ts < val_start, ``val`` if val_start <= ts < val_end; rows in no
    fold are dropped.  Fold bounds are dates, so each fold is expanded to the days
    it covers (a table of days x folds; the planner broadcasts it by its size) and rows
    join on their date: an equi-join, never a nested loop."""
    days = folds.select(
        F.col("fold").alias(fold_col), F.col("val_start").cast("date").alias("_vs"),
        F.explode(F.sequence(F.col("train_start").cast("date"), F.date_sub(F.col("val_end").cast("date"), 1))).alias("_day"))
    days = days.select(fold_col, "_day", F.when(F.col("_day") < F.col("_vs"), "train").otherwise("val").alias(role_col))
    j = df.join(days, F.to_date(F.col(ts)) == F.col("_day"), "inner")
    return j.drop("_day")


def year_split(df: DataFrame, ts: str, mapping: Mapping[str, Sequence[int]], out: str = "split") -> DataFrame:
    """V4: split by calendar year, e.g. ``{"train": range(2015, 2018), "val": [2018]}``;
    years in no list are dropped."""
    y = F.year(F.col(ts))
    e = None
    for name, years in mapping.items():
        cond = y.isin([int(v) for v in years])
        e = F.when(cond, name) if e is None else e.when(cond, name)
    return df.withColumn(out, e).filter(F.col(out).isNotNull())


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "split") -> DataFrame:
    """Union by name with a source tag column."""
    out = None
    for name, d in parts.items():
        d = d.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def hash_sample(df: DataFrame, fraction: float, key: str | Column, seed: int = 42) -> DataFrame:
    """V7: keep rows with ``hash_unit(seed:key) < fraction`` (deterministic)."""
    return df.filter(hash_unit(key, seed) < F.lit(float(fraction)))


def keep_majority(y: str, key: str | Column, positives: int, negatives: int, target_ratio: float = 1.0, seed: int = 42,
                  majority: int = 0) -> Column | None:
    """V6 as a condition from known class counts; None where every row stays."""
    keep = positives / negatives / target_ratio if negatives else 1.0
    if keep >= 1.0:
        return None
    return (F.col(y) != majority) | F.col(y).isNull() | (hash_unit(key, seed) < F.lit(float(keep)))


def downsample(df: DataFrame, y: str, key: str | Column, target_ratio: float = 1.0, seed: int = 42,
               majority: int = 0, minority: int = 1) -> DataFrame:
    """V6: keep every minority row and a hash-chosen share
    ``keep = (minority/majority) / target_ratio`` of the majority rows; no-op if
    keep >= 1.  One count pass, then a single filter (no union)."""
    row = df.agg(F.count_if(F.col(y) == minority).alias("pos"), F.count_if(F.col(y) == majority).alias("neg")).first()
    cond = keep_majority(y, key, row["pos"], row["neg"], target_ratio, seed, majority)
    return df if cond is None else df.filter(cond)


def fold_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Literal fold table ``(fold, train_start, val_start, val_end)`` (dates as ISO strings)."""
    return (spark.createDataFrame(list(rows), "fold int, train_start string, val_start string, val_end string")
            .select("fold", *[F.to_date(c).alias(c) for c in ("train_start", "val_start", "val_end")]))
