"""Medians, sweeps, curves and early stopping on the cases that size or shape makes hard."""

import math
import random

import pytest
from pyspark.sql import functions as F

from eventfeat.operators import evaluate as EV
from eventfeat.operators import profile as P


def _lower_median(values):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return v[(len(v) - 1) // 2] if v else None


def test_medians_with_infinities_and_outliers(spark):
    rng = random.Random(2)
    rows = [(float(k % 7), rng.choice([math.inf, -math.inf, 1.5]), rng.gauss(0, 1) * 10 ** rng.randint(-300, 300), None, math.nan if k % 2 else 4.0,
             1e308 if k < 2600 else -1e308) for k in range(5001)]
    cols = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = P._exact_medians(df, cols)
    assert got == {c: _lower_median([r[i] for r in rows]) for i, c in enumerate(cols)}


def test_median_of_a_million_rows_with_infinities(spark):
    x = F.pmod(F.col("id") * 7919, F.lit(1_000_003)).cast("double")
    df = spark.range(1_000_003).select(F.when(F.col("id") % 10 == 0, F.lit(math.inf)).when(F.col("id") % 10 == 1, F.lit(-math.inf)).otherwise(x).alias("x"))
    want = df.selectExpr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x) AS m").first()["m"]
    assert P.fit_median(df, "x") == want


def test_upstream_runs_once_for_all_medians(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, 1, 2).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id * id AS DOUBLE) AS b").mapInArrow(count, "a double, b double")
    policy = P.fit_null_policy(df, median=["a", "b"])
    assert policy.values == {"a": 499.0, "b": 499.0 ** 2} and runs.value == 1000


@pytest.mark.parametrize("inclusive", [True, False])
def test_sweep_counts_each_row_once(spark, inclusive):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1, None]), rng.choice([0.1, 0.5, 0.50001, 0.9, None, rng.random()])) for _ in range(800)]
    rows += [("only null", 1, None)]
    cuts = [0.9, 0.5, 0.1, 0.5, 1.5]  # unsorted, with a repeat
    got = EV.threshold_sweep(spark.createDataFrame(rows, "g string, y int, p double"), "y", "p", cuts, by="g", inclusive=inclusive)
    rows_of = [(r["g"], r["threshold"], r["tp"], r["fp"], r["fn"]) for r in got.collect()]
    want = []
    for g in ("a", "b", None, "only null"):
        part = [(y, p) for k, y, p in rows if k == g and p is not None]
        for t in cuts:
            hit = [(y, p >= t if inclusive else p > t) for y, p in part]
            want.append((g, t, sum(h and y == 1 for y, h in hit), sum(h and y == 0 for y, h in hit), sum(not h and y == 1 for y, h in hit)))
    assert sorted(rows_of, key=repr) == sorted(want, key=repr)


def test_sweep_never_multiplies_rows(spark):
    df = spark.range(100).selectExpr("CAST(id % 2 AS INT) AS y", "id / 100 AS p")
    plan = EV.threshold_sweep(df, "y", "p", [k / 50 for k in range(50)])._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate"):]
    assert plan.count("Generate") == 1 and "Aggregate" in below and "Generate" not in below[below.index("Aggregate"):]


def _replay(values, patience, delta):
    best = best_at = None
    wait = 0
    for n, v in enumerate(values):
        if best is None or (v is not None and v > best + delta):
            best, best_at, wait = v, n, 0
        else:
            wait += 1
        if wait >= patience:
            break
    return best_at, best, n, n + 1


@pytest.mark.parametrize("patience", [1, 2, 5])
def test_early_stopping_equals_a_replay(spark, patience):
    rng = random.Random(patience)
    folds = {}
    for f in range(120):
        v, at = [], 0.0
        for _ in range(rng.randint(1, 25)):
            at += rng.choice([0.05, 0.1, 0.2, -0.1, 0.0])
            v.append(rng.choice([at, at, at, None, round(rng.random(), 1)]))
        folds[f] = v
    rows = [(f, n, v) for f, vs in folds.items() for n, v in enumerate(vs)]
    rng.shuffle(rows)
    got = EV.best_step(spark.createDataFrame(rows, "fold int, step int, value double"), patience=patience, min_delta=0.1).collect()
    assert sorted(tuple(r) for r in got) == [(f, *_replay(v, patience, 0.1)) for f, v in sorted(folds.items())]


def test_early_stopping_over_a_million_steps(spark):
    df = spark.range(1_000_000).selectExpr("1 AS fold", "id AS step", "CASE WHEN id <= 5 THEN id * 1.0 ELSE 5.0 - id * 1e-7 END AS value")
    assert tuple(EV.best_step(df, patience=1000).first()) == (1, 5, 5.0, 1005, 1006)
    rising = spark.range(300_000).selectExpr("1 AS fold", "id AS step", "id * 1.0 AS value")  # every step is better
    assert tuple(EV.best_step(rising, patience=2).first()) == (1, 299_999, 299_999.0, 299_999, 300_000)


def test_curves_do_not_depend_on_the_partitions(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", None]), int(rng.random() < 0.3), rng.choice([rng.random(), 0.5, None, math.nan])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in EV.curve_areas(df, "y", "s", by="g").fillna("-", ["g"]).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 2
