"""Model evaluation computed in Spark (E13-E18, X14 mean, S9 queries).

Curve metrics are exact over distinct scores.  Cumulative counts use a two-level
prefix: per-score counts are range-partitioned by score, partition totals are prefix-summed
(one row per group and partition), and the running counts inside a partition start there
-- so no single task ever sorts a whole fold's scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventfeat.functions.numeric import focal_loss
from eventfeat.sources.io import scratch_path


def _grp(by) -> list[str]:
    return [] if not by else ([by] if isinstance(by, str) else list(by))


def _fbeta(p: Column, r: Column, beta: float) -> Column:
    b2 = beta * beta
    return F.when((p + r) == 0, F.lit(0.0)).otherwise((1 + b2) * p * r / (b2 * p + r))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _same_group(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns where NULL equals NULL."""
    keys = {c: f"_on_{c}" for c in on}
    b = b.withColumnsRenamed(keys)
    same = F.lit(True)
    for c, k in keys.items():
        same = same & a[c].eqNullSafe(b[k])
    return a.join(b, same, "inner").drop(*keys.values())


def confusion(df: DataFrame, y: str, pred: str, by=None) -> DataFrame:
    """tp, fp, fn, tn per group (one conditional aggregate)."""
    g = _grp(by)
    yy, pp = F.col(y).cast("double"), F.col(pred).cast("double")
    aggs = [F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy != 1) & (pp == 1)).alias("fp"),
            F.count_if((yy == 1) & (pp != 1)).alias("fn"), F.count_if((yy != 1) & (pp != 1)).alias("tn")]
    return df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)


def _threshold_metrics(c: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1_1, f1_0 = _fbeta(p1, r1, 1.0), _fbeta(p0, r0, 1.0)
    return c.withColumns({
        "precision": p1, "recall": r1, "f1_pos": f1_1, "f2_pos": _fbeta(p1, r1, 2.0),
        "f1_weighted": _ratio((tp + fn) * f1_1 + (tn + fp) * f1_0, n),
        "accuracy": _ratio(tp + tn, n),
    })


def _curve(df: DataFrame, y: str, score: str, by=None) -> DataFrame:
    """Per distinct score (desc): cumulative tp/fp including and excluding it,
    plus group totals P, N.  The scored rows are read once: their counts per score are
    range-partitioned and written to the shared scratch folder, because both uses must see
    one partitioning and range bounds are sampled anew whenever a plan runs again."""
    g = _grp(by)
    yy, s = F.col(y).cast("double"), F.col(score).cast("double")
    per = df.groupBy(*g, s.alias("_s")).agg(F.count_if(yy == 1).alias("_p"), F.count_if(yy != 1).alias("_n"))
    odd = F.when(F.isnan("_s"), 2).when(F.col("_s").isNull(), 1).otherwise(0)
    order = [F.col("_odd").desc(), F.col("_s").desc()]
    per = (per.withColumn("_odd", odd).repartitionByRange(*[F.col(c) for c in g], *order)
           .withColumn("_bk", F.spark_partition_id()))
    path = scratch_path(df.sparkSession, "curve")
    per.write.parquet(path)
    per = df.sparkSession.read.schema(per.schema).parquet(path)
    bt = per.groupBy(*g, "_bk").agg(F.sum("_p").alias("_bp"), F.sum("_n").alias("_bn"))
    wall = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(1))
    wb = wall.orderBy("_bk").rowsBetween(Window.unboundedPreceding, 0)
    bt = bt.select(*g, "_bk", (F.sum("_bp").over(wb) - F.col("_bp")).alias("_op"), (F.sum("_bn").over(wb) - F.col("_bn")).alias("_on"),
                   F.sum("_bp").over(wall).alias("P"), F.sum("_bn").over(wall).alias("N"))
    per = _same_group(per, bt, [*g, "_bk"])
    wi = Window.partitionBy(*g, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return per.select(*g, "_s", "P", "N",
                      (F.col("_op") + F.sum("_p").over(wi)).alias("tp"),
                      (F.col("_on") + F.sum("_n").over(wi)).alias("fp"),
                      (F.col("_op") + F.sum("_p").over(wi) - F.col("_p")).alias("tp0"),
                      (F.col("_on") + F.sum("_n").over(wi) - F.col("_n")).alias("fp0"))


def curve_areas(df: DataFrame, y: str, score: str, by=None) -> DataFrame:
    """roc_auc (trapezoid), pr_auc (trapezoid, first precision repeated at recall 0,
    as Spark's evaluator) and average_precision (step, as the sklearn definition)."""
    g = _grp(by)
    c = _curve(df, y, score, by)
    P, N = F.col("P"), F.col("N")
    tp, fp, tp0, fp0 = F.col("tp"), F.col("fp"), F.col("tp0"), F.col("fp0")
    prec = tp / (tp + fp)
    prec0 = F.when((tp0 + fp0) == 0, prec).otherwise(tp0 / (tp0 + fp0))
    roc = _ratio((fp - fp0), N) * _ratio(tp + tp0, 2 * P)
    dr = _ratio(tp - tp0, P)
    terms = c.select(*g, roc.alias("_roc"), (dr * (prec + prec0) / 2).alias("_pr"), (dr * prec).alias("_ap"))
    aggs = [F.sum("_roc").alias("roc_auc"), F.sum("_pr").alias("pr_auc"), F.sum("_ap").alias("average_precision")]
    return terms.groupBy(*g).agg(*aggs) if g else terms.agg(*aggs)


def classification_metrics(df: DataFrame, y: str, pred: str, score: str, by=None) -> DataFrame:
    """Recall, precision, F1 (class 1 and weighted), F2, accuracy,
    confusion counts, ROC-AUC, PR-AUC and average precision per group (a NULL group is a
    group).  NaN scores rank highest, then NULL."""
    g = _grp(by)
    if not g:
        return classification_metrics(df.withColumn("_all", F.lit(1)), y, pred, score, "_all").drop("_all")
    m = _threshold_metrics(confusion(df, y, pred, by))
    return _same_group(m, curve_areas(df, y, score, by), g)


def _passed(p: Column, cuts: Sequence[float], inclusive: bool) -> Column:
    """How many of the ascending ``cuts`` a score reaches, by binary search."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        reach = (p >= F.lit(cuts[mid])) if inclusive else (p > F.lit(cuts[mid]))
        return F.when(reach, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(cuts))


def threshold_sweep(df: DataFrame, y: str, p: str, thresholds: Sequence[float], by=None, beta: float = 2.0,
                    inclusive: bool = True) -> DataFrame:
    """precision/recall/F1/F2 at every threshold in one pass: each row is counted
    once, under the number of thresholds that its score reaches, and suffix sums over these
    counts (one more than thresholds per group) give all thresholds.  ``is_best`` marks
    the max F-beta, the earliest listed threshold winning ties.  NULL scores count nowhere."""
    g = _grp(by)
    cuts = sorted(float(t) for t in thresholds)
    x = df.select(*g, F.col(y).cast("double").alias("_y"), F.col(p).cast("double").alias("_p"))
    x = x.withColumn("_b", F.when(F.col("_p").isNotNull(), _passed(F.col("_p"), cuts, inclusive)))
    x = x.groupBy(*g, "_b").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") != 1).alias("neg"))
    cells = F.collect_list(F.when(F.col("_b").isNotNull(), F.struct("_b", "pos", "neg"))).alias("_c")
    per = x.groupBy(*g).agg(cells) if g else x.agg(cells)

    def total(name: str, k: int, above: bool) -> Column:
        cells = F.filter("_c", lambda c: (c["_b"] > k) if above else (c["_b"] <= k))
        return F.aggregate(cells, F.lit(0).cast("long"), lambda a, c: a + c[name])

    rows = F.array(*[F.struct(
        F.lit(i).alias("_i"), F.lit(float(t)).alias("threshold"), total("pos", cuts.index(float(t)), True).alias("tp"),
        total("neg", cuts.index(float(t)), True).alias("fp"), total("pos", cuts.index(float(t)), False).alias("fn"))
        for i, t in enumerate(thresholds)])
    c = per.select(*g, F.inline(rows))
    pr, rc = _ratio(F.col("tp"), F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    c = c.withColumns({"precision": pr, "recall": rc, "f1": _fbeta(pr, rc, 1.0), "f2": _fbeta(pr, rc, beta)})
    w = Window.partitionBy(*g).orderBy(F.col("f2").desc(), F.col("_i")) if g else \
        Window.partitionBy(F.lit(1)).orderBy(F.col("f2").desc(), F.col("_i"))
    return c.withColumn("is_best", (F.row_number().over(w) == 1).cast("int")).drop("_i")


def focal_mean(df: DataFrame, y: str, p: str | None = None, logit: str | None = None, alpha: float = 0.75,
               gamma: float = 2.0, by=None) -> DataFrame:
    """Mean focal loss per group."""
    g = _grp(by)
    fl = focal_loss(p=F.col(p) if p else None, y=F.col(y), alpha=alpha, gamma=gamma,
                    logit=F.col(logit) if logit else None)
    x = df.select(*g, fl.alias("_fl"))
    a = [F.avg("_fl").alias("focal_loss"), F.count(F.lit(1)).alias("rows")]
    return x.groupBy(*g).agg(*a) if g else x.agg(*a)


# ------------------------------------------------------------------ E16-E18 on a metric log

def best_step(metrics: DataFrame, fold: str = "fold", step: str = "step", value: str = "value",
              patience: int = 2, min_delta: float = 1e-4) -> DataFrame:
    """Early-stopping replay per fold: a step counts as better only if it
    beats the best so far by more than ``min_delta``; stop after ``patience``
    non-improving steps.  Output: fold, best_step, best_value, stop_step, steps_seen.

    A better step is always a new strict maximum (what is not better is at most
    ``min_delta`` above the best), so a running-maximum window leaves the records, and of
    these the first island: a gap of more than ``patience`` steps between records ends the
    replay in any case.  Only these records are folded, not the fold's steps."""
    w = Window.partitionBy(fold).orderBy("_s", "_v")
    d = metrics.select(fold, F.col(step).alias("_s"), F.col(value).cast("double").alias("_v"))
    d = d.select("*", F.row_number().over(w).alias("_n"), F.lead("_s", patience).over(w).alias("_stop"),
                 F.max("_v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_top"))
    ends = d.groupBy(fold).agg(F.max("_n").alias("_rows"), F.max_by("_s", "_n").alias("_last"))
    rec = d.filter(F.col("_top").isNull() | (F.col("_v") > F.col("_top")))
    wr = Window.partitionBy(fold).orderBy("_n")
    rec = rec.withColumn("_gap", (F.col("_n") - F.lag("_n").over(wr) > patience).cast("int"))
    gaps = F.coalesce(F.sum("_gap").over(wr.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rec = rec.withColumn("_island", gaps).filter("_island = 0")
    def upd(acc, x):
        better = acc.isNull() | acc["_v"].isNull() | (x["_v"] > acc["_v"] + F.lit(min_delta))
        return F.when(F.coalesce(acc["_n"] + patience < x["_n"], F.lit(False)) | ~better, acc).otherwise(x)

    cells = F.array_sort(F.collect_list(F.struct("_n", "_s", "_v", "_stop")))
    kind = rec.select(F.struct("_n", "_s", "_v", "_stop").alias("x")).schema["x"].dataType
    best = rec.groupBy(fold).agg(F.aggregate(cells, F.lit(None).cast(kind), upd).alias("_r"))
    out = _same_group(best, ends, [fold])
    stopped = F.col("_r._n") + patience <= F.col("_rows")
    return out.select(fold, F.col("_r._s").alias("best_step"), F.col("_r._v").alias("best_value"),
                      F.when(stopped, F.col("_r._stop")).otherwise(F.col("_last")).alias("stop_step"),
                      F.when(stopped, F.col("_r._n") + patience).otherwise(F.col("_rows")).cast("int").alias("steps_seen"))


def fold_summary(metrics_wide: DataFrame, fold: str, select_by: str, cols: Sequence[str], step: str = "step") -> DataFrame:
    """Per fold, the step with the greatest ``select_by`` (ties: the earliest
    step, as a strictly-improving tracker keeps it) and its ``cols``."""
    best = F.max_by(F.struct(F.col(step).alias(step), *[F.col(c) for c in cols if c != step]),
                    F.struct(F.col(select_by), -F.col(step)))
    return metrics_wide.groupBy(fold).agg(F.max(select_by).alias(f"best_{select_by}"), best.alias("_b")).select(
        fold, f"best_{select_by}", F.col("_b")[step].alias(step), *[F.col("_b")[c].alias(c) for c in cols if c != step])


def gap_report(summary: DataFrame, train_col: str, val_col: str, baseline: float, overfit_gap: float = 0.1) -> DataFrame:
    """Train-val gap, overfit flag (gap > ``overfit_gap``), beats-baseline flag."""
    gap = F.col(train_col) - F.col(val_col)
    return summary.withColumns({"gap": gap, "overfit": (gap > overfit_gap).cast("int"),
                                "beats_baseline": (F.col(val_col) > baseline).cast("int")})
