"""Profiling, audit and fill operators.

Each profile is one aggregate pass (partial aggregation before the shuffle); only
the handful of fitted scalars (medians, skews, means) ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfeat.functions.numeric import balance_alpha, signed_log
from eventfeat.sources.io import scratch_path


def time_span(df: DataFrame, ts: str) -> DataFrame:
    """A4: ``min_time, max_time`` in one pass."""
    return df.agg(F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: long table ``column, null_count, null_pct`` (one aggregate pass, then an
    unpivot of the single result row), sorted by count desc then name."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    long = one.selectExpr("_rows", f"stack({len(cols)}, {stack}) as (column, null_count)")
    return (long.select("column", F.col("null_count").cast("long").alias("null_count"),
                        F.when(F.col("_rows") > 0, F.col("null_count") * 100.0 / F.col("_rows")).alias("null_pct"))
            .orderBy(F.col("null_count").desc(), F.col("column")))


def expected_nulls_report(profile: DataFrame, expected: Sequence[str], present: Sequence[str]) -> dict[str, list[str]]:
    """A5 (set differences): expected-but-missing columns, unexpected null columns,
    expected columns without nulls.  ``profile`` is ``null_profile`` output (small)."""
    with_nulls = {r["column"] for r in profile.filter(F.col("null_count") > 0).select("column").collect()}
    exp = set(expected)
    return {
        "missing_expected": sorted(exp - set(present)),
        "unexpected_nulls": sorted(with_nulls - exp),
        "expected_without_nulls": sorted(exp - with_nulls),
    }


def leakage_audit(df: DataFrame, hours_col: str, threshold_h: float, guarded: Sequence[str]) -> DataFrame:
    """Rows where the gap is below the lead time but a guarded feature is set
    (must be 0), plus the at-risk and total row counts."""
    risk = F.col(hours_col) < F.lit(threshold_h)
    aggs = [F.count_if(risk & F.col(c).isNotNull()).alias(f"{c}_violations") for c in guarded]
    aggs += [F.count_if(risk).alias("at_risk_rows"), F.count(F.lit(1)).alias("total_rows")]
    return df.agg(*aggs)


SKETCH_ACCURACY = 10_000  # a percentile sketch errs by at most 1/10,000 of its rows


def _exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Lower medians of many columns together, NULL and NaN left out.

    The columns are written once, so the plan above runs a single time.  A round is two
    aggregates for all columns: percentile sketches around each median's rank, then exact
    counts below and at the percentiles.  Each round leaves an open interval with about a
    thousandth of the values, wherever they lie (ranks, not distances: infinities and
    outliers change nothing), until the median itself is one of the percentiles."""
    spark = df.sparkSession
    path = scratch_path(spark, "medians")
    x = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    x.write.parquet(path)
    x = spark.read.schema(x.schema).parquet(path)
    n = x.agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    out: dict[str, float | None] = {c: None for c in cols}
    # per column: rank among the values inside (lo, hi), their number, the open bounds
    todo = {i: ((n[f"c{i}"] + 1) // 2, n[f"c{i}"], None, None) for i in range(len(cols)) if n[f"c{i}"]}
    while todo:
        inside, want = {}, []
        for i, (k, m, lo, hi) in todo.items():
            v, ok = F.col(f"c{i}"), F.lit(True)
            ok = ok if lo is None else ok & (v > F.lit(lo))
            inside[i] = F.when(ok if hi is None else ok & (v < F.lit(hi)), v)
            at = [min(1.0, max(0.0, (k - 0.5) / m + d)) for d in (-2 / SKETCH_ACCURACY, 0, 2 / SKETCH_ACCURACY)]
            want.append(F.percentile_approx(inside[i], at, SKETCH_ACCURACY).alias(f"c{i}"))
        got = x.agg(*want).first()
        cuts = {i: sorted(set(got[f"c{i}"])) for i in todo}
        counts = x.agg(*[f(inside[i], c).alias(f"{name}{i}_{j}") for i in todo for j, c in enumerate(cuts[i])
                         for name, f in (("lt", lambda v, c: F.count_if(v < F.lit(c))), ("eq", lambda v, c: F.count_if(v == F.lit(c))))]).first()
        left = {}
        for i, (k, m, lo, hi) in todo.items():
            below, start = 0, lo
            for j, c in enumerate(cuts[i]):
                lt, eq = counts[f"lt{i}_{j}"], counts[f"eq{i}_{j}"]
                if k <= lt:
                    left[i] = (k - below, lt - below, start, c)
                    break
                if k <= lt + eq:
                    out[cols[i]] = float(c)
                    break
                below, start = lt + eq, c
            else:
                left[i] = (k - below, m - below, start, hi)
        todo = left
    return out


def fit_median(df: DataFrame, col: str, exact: bool = True, rel_error: float = 0.01) -> float | None:
    """Median of ``col``, NULL and NaN left out.  ``exact`` gives the lower median (an
    element of the data) at any size; otherwise ``approxQuantile`` with ``rel_error``."""
    if exact:
        return _exact_medians(df, [col])[col]
    v = df.approxQuantile(col, [0.5], rel_error)
    return float(v[0]) if v else None


def skew_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness m3 / m2^1.5 per column, one pass, long form
    ``column, skewness``."""
    one = df.agg(*[F.skewness(F.col(c)).alias(f"s{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', s{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {stack}) as (column, skewness)")


@dataclass
class SkewLog:
    """X9 fitted: which columns get ``<col>_log = sign(x) log1p|x|``."""
    cols: list[str]
    skews: dict[str, float | None] = field(default_factory=dict)
    suffix: str = "_log"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}{self.suffix}": signed_log(F.col(c)) for c in self.cols}) if self.cols else df


def fit_skew_log(train: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> SkewLog:
    """Measure skewness on the training rows only; |skew| > threshold -> log."""
    row = train.agg(*[F.skewness(F.col(c)).alias(c) for c in cols]).first().asDict()
    chosen = [c for c in cols if row.get(c) is not None and abs(row[c]) > threshold]
    return SkewLog(chosen, row)


def split_stats(df: DataFrame, by: str = "split") -> DataFrame:
    """Rows per split and share of all rows (window over the tiny aggregate)."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    return g.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(F.lit(1))))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """A10: keys occurring more than once, with their counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_summary(df: DataFrame) -> DataFrame:
    """A10: total rows vs distinct full rows, from one group-by over all columns."""
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return (g.agg(F.sum("_n").cast("long").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows"))
            .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows")))


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Distinct values (hash aggregate, partial before the shuffle)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct()


def class_balance(df: DataFrame, y: str, by: Sequence[str] = (), lo: float = 0.5, hi: float = 0.85) -> DataFrame:
    """Positive rate, counts and the balance weight alpha = min(hi, max(lo, 1-p))."""
    g = df.groupBy(*by) if by else df
    out = g.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(y).cast("long")).alias("positives"),
                F.avg(F.col(y).cast("double")).alias("pos_rate"))
    return out.withColumn("alpha", balance_alpha(F.col("pos_rate"), lo, hi))


# ------------------------------------------------------------------ X11 null policy

@dataclass
class NullPolicy:
    """Fitted fill values; ``apply`` fills only columns present, each with a value
    of the column's own type (no string '0' in numeric columns)."""
    values: dict[str, object]

    def apply(self, df: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in df.schema.fields}
        cols = {}
        for c, v in self.values.items():
            if c in have and v is not None:
                cols[c] = F.coalesce(F.col(c), F.lit(v).cast(have[c]))
        return df.withColumns(cols) if cols else df


def fit_null_policy(train: DataFrame, zero: Sequence[str] = (), median: Sequence[str] = (),
                    const: Mapping[str, object] | None = None, exact_median: bool = True) -> NullPolicy:
    """X11: zero-fill list, median-fill list (medians from ``train``), constants;
    only for columns that exist."""
    have = set(train.columns)
    vals: dict[str, object] = {c: 0 for c in zero if c in have}
    med = [c for c in median if c in have]
    if med:
        if exact_median:
            vals.update(_exact_medians(train, med))
        else:
            qs = train.approxQuantile(med, [0.5], 0.01)
            vals.update({c: (q[0] if q else None) for c, q in zip(med, qs)})
    for c, v in (const or {}).items():
        if c in have:
            vals[c] = v
    return NullPolicy(vals)


def flags_to_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> 0.0 and cast to double for each flag column."""
    return df.withColumns({c: F.coalesce(F.col(c).cast(T.DoubleType()), F.lit(0.0)) for c in cols})
