"""Queries for the feature pipeline, training/scoring and evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eventfeat.functions import numeric as N
from eventfeat.operators import evaluate as EV
from eventfeat.operators import features as FE
from eventfeat.operators import split as SP
from eventfeat.operators.folds import process_folds
from eventfeat.operators.split import hash_sample
from eventfeat.plans.fixtures import fixture, with_fixtures
from eventfeat.plans.presets import BASELINE_PR_AUC, EARLY_STOP_MIN_DELTA, EARLY_STOP_PATIENCE, OVERFIT_GAP, SWEEP_THRESHOLDS
from eventfeat.plans.registry import register
from eventfeat.plans.tables import Tables

R6 = 6
_CUT = "1999-01-01"


def _is_train(c="o_orderdate"):
    return F.col(c) < F.lit(_CUT).cast("timestamp_ntz")


# ---------------------------------------------------------------- E1 / E2 / E7

def _index_model(spark, d):
    df = fixture(spark, d, "orders_dirty")
    return df, FE.fit_index(df.filter(_is_train()), ["o_orderpriority", "prio_str"])


def _labels_sql(col: str) -> str:
    return (f"(SELECT {col} AS v, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS idx FROM orders_dirty "
            f"WHERE o_orderdate < TIMESTAMP '{_CUT}' AND {col} IS NOT NULL GROUP BY {col})")


_E1_SQL = with_fixtures(f"""
WITH l1 AS {_labels_sql('o_orderpriority')}, l2 AS {_labels_sql('prio_str')},
     n1 AS (SELECT count(*) AS n FROM l1), n2 AS (SELECT count(*) AS n FROM l2)
SELECT o.o_orderkey, CAST(coalesce(l1.idx, n1.n) AS DOUBLE) AS o_orderpriority_idx,
       CAST(coalesce(l2.idx, n2.n) AS DOUBLE) AS prio_str_idx
FROM orders_dirty o LEFT JOIN l1 ON o.o_orderpriority = l1.v LEFT JOIN l2 ON o.prio_str = l2.v, n1, n2""", "orders_dirty")


@register("e1_string_index", _E1_SQL)
def q_e1(spark, d):
    df, m = _index_model(spark, d)
    return m.transform(df).select("o_orderkey", "o_orderpriority_idx", "prio_str_idx")


@register("e2_onehot", with_fixtures(f"""
WITH l1 AS {_labels_sql('o_orderpriority')}, n1 AS (SELECT count(*) AS n FROM l1),
     i AS (SELECT o.o_orderkey, coalesce(l1.idx, n1.n) AS idx, n1.n AS n FROM orders_dirty o LEFT JOIN l1 ON o.o_orderpriority = l1.v, n1)
SELECT o_orderkey, CAST(n AS INTEGER) AS ohe_size, CAST(CASE WHEN idx < n THEN idx END AS INTEGER) AS ohe_index FROM i""",
                                      "orders_dirty"))
def q_e2(spark, d):
    from pyspark.ml.feature import OneHotEncoder
    df, m = _index_model(spark, d)
    idx = m.transform(df)
    enc = OneHotEncoder(inputCol="o_orderpriority_idx", outputCol="prio_ohe").fit(idx.filter(_is_train()))
    return FE.ohe_positions(enc.transform(idx), "prio_ohe").select("o_orderkey", "ohe_size", "ohe_index")


@register("e7_cardinalities", with_fixtures(f"""
SELECT 'o_orderpriority' AS column, CAST(count(DISTINCT o_orderpriority) + 1 AS INTEGER) AS cardinality
FROM orders_dirty WHERE o_orderdate < TIMESTAMP '{_CUT}'
UNION ALL SELECT 'prio_str', CAST(count(DISTINCT prio_str) + 1 AS INTEGER) FROM orders_dirty WHERE o_orderdate < TIMESTAMP '{_CUT}'""",
                                              "orders_dirty"))
def q_e7(spark, d):
    _, m = _index_model(spark, d)
    return spark.createDataFrame(FE.cardinalities(m), "column string, cardinality int")


# ---------------------------------------------------------------- E3 / E4 / E6 / E10

_SCALE_COLS = ["o_totalprice", "o_custkey_d"]


def _scale_frame(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_totalprice",
                                          F.col("o_custkey").cast("double").alias("o_custkey_d"))


def _scaled(spark, d, sample: float | None = None):
    df = _scale_frame(spark, d)
    train = df.filter(_is_train())
    if sample is not None:
        train = hash_sample(train, sample, "o_orderkey", seed=42)
    m = FE.fit_scaler(train, _SCALE_COLS, with_mean=True, out="scaled")
    return FE.scaled_columns(m.transform(df), "scaled", _SCALE_COLS)


def _scale_sql(where_extra: str = "") -> str:
    st = f"SELECT avg(o_totalprice) AS m1, stddev_samp(o_totalprice) AS s1, avg(CAST(o_custkey AS DOUBLE)) AS m2, " \
         f"stddev_samp(CAST(o_custkey AS DOUBLE)) AS s2 FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}' {where_extra}"
    return (f"SELECT o_orderkey, round((o_totalprice - m1) / s1, {R6}) AS o_totalprice_num, "
            f"round((CAST(o_custkey AS DOUBLE) - m2) / s2, {R6}) AS o_custkey_d_num FROM orders, ({st}) st")


@register("e4_scaler", _scale_sql())
def q_e4(spark, d):
    r = _scaled(spark, d)
    return r.select("o_orderkey", *[F.round(f"{c}_num", R6).alias(f"{c}_num") for c in _SCALE_COLS])


_HASH = "(CAST(('0x' || substr(md5('42:' || CAST(o_orderkey AS STRING)), 1, 8)) AS BIGINT) / 4294967296.0)"


@register("e6_sampled_scaler", _scale_sql(f"AND {_HASH} < 0.1"))
def q_e6(spark, d):
    r = _scaled(spark, d, sample=0.1)
    return r.select("o_orderkey", *[F.round(f"{c}_num", R6).alias(f"{c}_num") for c in _SCALE_COLS])


def _elements(vec: str, n: int, name: str, digits: int | None = None):
    """The elements of a vector as columns, NaN as NULL."""
    arr = vector_to_array(F.col(vec))
    out = []
    for i in range(n):
        x = F.when(~F.isnan(arr[i]), arr[i])
        out.append((F.round(x, digits) if digits else x).alias(f"{name}_{i}"))
    return out


@register("e3_assemble", with_fixtures("SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS f_0, CASE WHEN NOT isnan(o_rate) THEN o_rate END AS f_1, "
                                       "o_totalprice AS f_2 FROM orders_dirty", "orders_dirty"))
def q_e3(spark, d):
    df = fixture(spark, d, "orders_dirty").select("o_orderkey", F.col("o_custkey").cast("double").alias("c"),
                                                  "o_totalprice", "o_rate")
    out = FE.feature_pipeline(FE.FeatureSpec(numeric=["c", "o_totalprice", "o_rate"], categorical=[], binary=[], log_cols=[])).fit(df).transform(df)
    return out.select("o_orderkey", *_elements("full_unscaled_features", 3, "f"))  # numeric columns in name order


@register("s8_reloaded_scaler", _scale_sql())
def q_s8(spark, d):
    """A scaler that was saved and loaded gives what the fitted one gives."""
    from eventfeat.sources.io import load_model, save_model, scratch_path
    df = _scale_frame(spark, d)
    p = save_model(FE.fit_scaler(df.filter(_is_train()), _SCALE_COLS, with_mean=True, out="scaled"), scratch_path(spark, "scaler"))
    r = FE.scaled_columns(load_model(p).transform(df), "scaled", _SCALE_COLS)
    return r.select("o_orderkey", *[F.round(f"{c}_num", R6).alias(f"{c}_num") for c in _SCALE_COLS])


_FIXED_W = (0.3, -0.4, 0.9, 0.2, 0.1, -0.05)  # of the two inputs to each class, then the biases


@register("d2_fixed_model_score", f"""
WITH x AS ({_scale_sql().replace(f", {R6})", ", 15)")})
SELECT o_orderkey, round(1 / (1 + exp(-(({_FIXED_W[1]} - {_FIXED_W[0]}) * o_totalprice_num + ({_FIXED_W[3]} - {_FIXED_W[2]}) * o_custkey_d_num
  + ({_FIXED_W[5]} - {_FIXED_W[4]})))), 4) AS prob_pos FROM x""")
def q_d2(spark, d):
    """P(class 1) of a model with given weights (no training steps): E12 and D2."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors

    from eventfeat.operators.train import score
    df = _scaled(spark, d).withColumn("y", F.pmod("o_orderkey", F.lit(2)).cast("double"))
    model = MultilayerPerceptronClassifier(featuresCol="scaled", labelCol="y", layers=[2, 2], maxIter=0,
                                           initialWeights=Vectors.dense(_FIXED_W)).fit(df)
    return score(model, df).select("o_orderkey", F.round("prob_pos", 4).alias("prob_pos"))


@register("e10_model_columns", with_fixtures(f"""
WITH l1 AS {_labels_sql('o_orderpriority')}, n1 AS (SELECT count(*) AS n FROM l1),
     st AS (SELECT avg(o_totalprice) AS m1, stddev_samp(o_totalprice) AS s1, avg(CAST(o_custkey AS DOUBLE)) AS m2,
                   stddev_samp(CAST(o_custkey AS DOUBLE)) AS s2 FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}')
SELECT round((o.o_totalprice - m1) / s1, {R6}) AS o_totalprice_num, round((CAST(o.o_custkey AS DOUBLE) - m2) / s2, {R6}) AS o_custkey_d_num,
       CAST(coalesce(l1.idx, n1.n) AS INTEGER) AS o_orderpriority_cat,
       CAST(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END AS FLOAT) AS is_p_bin,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS FLOAT) AS target
FROM orders o JOIN orders_dirty d ON o.o_orderkey = d.o_orderkey LEFT JOIN l1 ON d.o_orderpriority = l1.v, n1, st""", "orders_dirty"))
def q_e10(spark, d):
    sc = _scaled(spark, d)
    df, m = _index_model(spark, d)
    o = Tables(spark, d).orders.select("o_orderkey", (F.col("o_orderstatus") == "P").cast("int").alias("is_p"),
                                       (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    j = sc.select("o_orderkey", "scaled").join(m.transform(df).select("o_orderkey", "o_orderpriority_idx"), "o_orderkey") \
          .join(o, "o_orderkey")
    r = FE.to_model_columns(j, "scaled", _SCALE_COLS, ["o_orderpriority"], ["is_p"], "y")
    return r.select(*[F.round(f"{c}_num", R6).alias(f"{c}_num") for c in _SCALE_COLS], "o_orderpriority_cat", "is_p_bin", "target")


# ---------------------------------------------------------------- E5, E11 / E12 (rows-only)

def _model_frame(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", "o_orderdate", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey_d"),
                    "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("prio_digit"),
                    (F.col("o_orderkey") % 2).cast("double").alias("odd_key"),
                    (F.col("o_orderstatus") == "F").cast("double").alias("y")) \
        .withColumn("o_totalprice_log", N.signed_log("o_totalprice"))


_SPEC = FE.FeatureSpec(numeric=["o_totalprice", "o_custkey_d"], categorical=["o_orderpriority", "prio_digit"],
                       binary=["odd_key"], log_cols=["o_totalprice"])


_VECTORS = ("log_scaled_features", "log_unscaled_features", "full_unscaled_features")


def _vectors_sql() -> str:
    """Numeric columns in name order, one-hot by frequency on the training rows, binary."""
    train = f"FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'"
    label = lambda e: f"(SELECT {e} AS v, row_number() OVER (ORDER BY count(*) DESC, {e}) - 1 AS idx {train} GROUP BY 1)"
    log = "sign(o_totalprice) * ln(1 + abs(o_totalprice))"
    stats = (f"(SELECT avg(CAST(o_custkey AS DOUBLE)) AS m1, stddev_samp(CAST(o_custkey AS DOUBLE)) AS s1, avg({log}) AS m2, "
             f"stddev_samp({log}) AS s2 {train})")
    key = "CAST(o_custkey AS DOUBLE)"
    numeric = {"log_scaled_features": [f"({key} - m1) / s1", f"({log} - m2) / s2"], "log_unscaled_features": [key, log],
               "full_unscaled_features": [key, "o_totalprice"]}
    cols = []
    for name in _VECTORS:
        parts = [f"round({x}, {R6})" for x in numeric[name]]
        parts += [f"CASE WHEN p.idx = {i} THEN 1.0 ELSE 0.0 END" for i in range(5)]
        parts += [f"CASE WHEN q.idx = {i} THEN 1.0 ELSE 0.0 END" for i in range(5)] + ["CAST(o_orderkey % 2 AS DOUBLE)"]
        cols += [f"CAST({x} AS DOUBLE) AS {name}_{i}" for i, x in enumerate(parts)]
    return (f"SELECT o_orderkey, {', '.join(cols)} FROM orders LEFT JOIN {label('o_orderpriority')} p ON p.v = o_orderpriority "
            f"LEFT JOIN {label('substr(o_orderpriority, 1, 1)')} q ON q.v = substr(o_orderpriority, 1, 1), {stats} st")


@register("e5_feature_vectors", _vectors_sql())
def q_e5(spark, d):
    df = _model_frame(spark, d)
    out = FE.feature_pipeline(_SPEC).fit(df.filter(_is_train())).transform(df)
    return out.select("o_orderkey", *[e for v in _VECTORS for e in _elements(v, 13, v, R6)])


# Fold processing: two folds of orders by date, all statistics per fold
_FOLDS = [(1, "1992-01-01", "1996-01-01", "1997-01-01"), (2, "1993-01-01", "1998-01-01", "1999-01-01")]


def _fold_vectors_sql() -> str:
    folds = ", ".join(f"({f}, TIMESTAMP '{a}', TIMESTAMP '{b}', TIMESTAMP '{c}')" for f, a, b, c in _FOLDS)
    log, key = "sign(o_totalprice) * ln(1 + abs(o_totalprice))", "CAST(o_custkey AS DOUBLE)"
    label = lambda e: (f"(SELECT fold, {e} AS v, row_number() OVER (PARTITION BY fold ORDER BY count(*) DESC, {e}) - 1 AS idx "  # noqa: E731
                       f"FROM w WHERE role = 'train' GROUP BY fold, {e})")
    numeric = {"log_scaled_features": [f"({key} - m1) / s1", f"({log} - m2) / s2"], "log_unscaled_features": [key, log],
               "full_unscaled_features": [key, "o_totalprice"]}
    cols = []
    for name in _VECTORS:
        parts = [f"round({x}, {R6})" for x in numeric[name]]
        parts += [f"CASE WHEN p.idx = {i} THEN 1.0 ELSE 0.0 END" for i in range(5)]
        parts += [f"CASE WHEN q.idx = {i} THEN 1.0 ELSE 0.0 END" for i in range(5)] + ["CAST(o_orderkey % 2 AS DOUBLE)"]
        cols += [f"CAST({x} AS DOUBLE) AS {name}_{i}" for i, x in enumerate(parts)]
    return f"""
WITH f AS (SELECT * FROM (VALUES {folds}) AS v(fold, a, b, c)),
w AS (SELECT o.*, fold, CASE WHEN o_orderdate < b THEN 'train' ELSE 'val' END AS role FROM orders o JOIN f ON o_orderdate >= a AND o_orderdate < c),
st AS (SELECT fold, avg({key}) AS m1, stddev_samp({key}) AS s1, avg({log}) AS m2, stddev_samp({log}) AS s2,
         count(*) FILTER (o_orderstatus = 'F') AS pos, count(*) FILTER (o_orderstatus <> 'F') AS neg FROM w WHERE role = 'train' GROUP BY fold)
SELECT o_orderkey, w.fold, role, {', '.join(cols)} FROM w JOIN st ON w.fold = st.fold
LEFT JOIN {label('o_orderpriority')} p ON p.v = o_orderpriority AND p.fold = w.fold
LEFT JOIN {label('substr(o_orderpriority, 1, 1)')} q ON q.v = substr(o_orderpriority, 1, 1) AND q.fold = w.fold
WHERE role = 'val' OR o_orderstatus = 'F' OR CAST(('0x' || substr(md5('42:' || CAST(o_orderkey AS STRING)), 1, 8)) AS BIGINT) / 4294967296.0 < pos / neg / 2.0"""


@register("v6_fold_features", _fold_vectors_sql())
def q_fold_features(spark, d):
    w = SP.assign_folds(_model_frame(spark, d).drop("o_totalprice_log"), "o_orderdate", SP.fold_table(spark, _FOLDS))
    spec = FE.FeatureSpec(numeric=_SPEC.numeric, categorical=_SPEC.categorical, binary=_SPEC.binary)
    out, _ = process_folds(w, spec, ["o_totalprice"], skew_threshold=0.0, target="y", key="o_orderkey", downsample_ratio=2.0)
    return out.select("o_orderkey", "fold", "role", *[e for v in _VECTORS for e in _elements(v, 13, v, R6)])


def _train_and_score(spark, d, reload: bool):
    from eventfeat.operators.train import ARCH, MAX_ITER, score, train_mlp
    from eventfeat.sources.io import load_model, save_model, scratch_path
    df = _model_frame(spark, d)
    train = df.filter(_is_train())
    pm = FE.feature_pipeline(_SPEC).fit(train)
    tr = pm.transform(train)
    arch = ARCH["mlp2" if reload else "mlp1"]
    model = train_mlp(tr, "log_scaled_features", "y", hidden=arch["hidden"], max_iter=MAX_ITER, step_size=arch["step_size"])
    test = pm.transform(df.filter(~_is_train()))
    if reload:
        p = scratch_path(spark, "mlp")
        save_model(pm, p + "/pipeline")
        save_model(model, p + "/model")
        pm2, model = load_model(p + "/pipeline"), load_model(p + "/model")
        test = pm2.transform(df.filter(~_is_train()))
    return score(model, test).select("o_orderkey", "prob_pos", "prediction")


@register("e11_train_mlp")
def q_e11(spark, d):
    return _train_and_score(spark, d, reload=False)


def _softmax_sql() -> str:
    """Newton's method for the same model: a network without hidden layers has one optimum."""
    p = "(1 / (1 + exp(-(w0 + w1 * a + w2 * b))))"
    h = {k: f"sum({p} * (1 - {p}) * {v})" for k, v in {"h00": "1", "h01": "a", "h02": "b", "h11": "a * a", "h12": "a * b", "h22": "b * b"}.items()}
    g = {k: f"sum(({p} - y) * {v})" for k, v in {"g0": "1", "g1": "a", "g2": "b"}.items()}
    sums = ", ".join(f"{e} AS {k}" for k, e in {**h, **g}.items())
    return f"""
WITH RECURSIVE t AS (SELECT CAST(o_custkey AS DOUBLE) AS k, ln(1 + o_totalprice) AS l,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'),
x AS (SELECT (k - avg(k) OVER ()) / stddev_samp(k) OVER () AS a, (l - avg(l) OVER ()) / stddev_samp(l) OVER () AS b, y FROM t),
it AS (SELECT 0 AS i, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2
  UNION ALL
  SELECT i + 1, w0 - (c00 * g0 + c01 * g1 + c02 * g2) / det, w1 - (c01 * g0 + c11 * g1 + c12 * g2) / det, w2 - (c02 * g0 + c12 * g1 + c22 * g2) / det
  FROM (SELECT *, h00 * c00 + h01 * c01 + h02 * c02 AS det FROM (
    SELECT *, h11 * h22 - h12 * h12 AS c00, h02 * h12 - h01 * h22 AS c01, h01 * h12 - h02 * h11 AS c02, h00 * h22 - h02 * h02 AS c11,
      h01 * h02 - h00 * h12 AS c12, h00 * h11 - h01 * h01 AS c22
    FROM (SELECT i, w0, w1, w2, {sums} FROM it, x GROUP BY i, w0, w1, w2) q) r) v WHERE i < 10)
SELECT count(*) AS rows, round(avg(ln(1 + exp(w0 + w1 * a + w2 * b)) - y * (w0 + w1 * a + w2 * b)), 5) AS loss, true AS stationary
FROM x, it WHERE i = 10"""


@register("e11_training_loss", _softmax_sql())
def q_e11_loss(spark, d):
    """Loss of a trained network without hidden layers, whose optimum SQL can find.  Blocks
    of one row, as the library's objective is a mean over blocks."""
    from eventfeat.operators.train import train_mlp, training_loss
    df = _model_frame(spark, d).filter(_is_train()).withColumn("y", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double"))
    tr = FE.feature_pipeline(FE.FeatureSpec(numeric=_SPEC.numeric, log_cols=_SPEC.log_cols)).fit(df).transform(df)
    model = train_mlp(tr, "numbers_scaled", "y", hidden=(), tol=1e-9, block_size=1)
    got = training_loss(model, tr, "numbers_scaled", "y")
    return got.select("rows", F.round("loss", 5).alias("loss"), (F.col("gradient") < 1e-3).alias("stationary"))


@register("e11_train_per_fold")
def q_e11f(spark, d):
    from eventfeat.operators.split import assign_folds, rolling_windows
    from eventfeat.operators.train import train_per_fold
    df = _model_frame(spark, d).filter(_is_train())
    windows = assign_folds(df, "o_orderdate", rolling_windows(df, "o_orderdate", 24, 12, 12))
    return train_per_fold(windows, _SPEC, "y", arch="mlp2")


@register("e12_score_reloaded")
def q_e12(spark, d):
    return _train_and_score(spark, d, reload=True)


# ---------------------------------------------------------------- E13-E15 metrics

def _metrics_sql(op: str) -> str:
    return with_fixtures(f"""
WITH p AS (SELECT fold, y, score, CASE WHEN score {op} 0.5 THEN 1 ELSE 0 END AS pred FROM orders_scored),
cm AS (SELECT fold, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND pred = 1) AS fp,
              count(*) FILTER (WHERE y = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND pred <> 1) AS tn FROM p GROUP BY fold),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
             CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0 FROM cm),
m2 AS (SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f11,
              CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f10,
              CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 5 * p1 * r1 / (4 * p1 + r1) END AS f2 FROM m),
per AS (SELECT fold, score AS s, count(*) FILTER (WHERE y = 1) AS np, count(*) FILTER (WHERE y <> 1) AS nn FROM p GROUP BY fold, score),
cum AS (SELECT fold, np, nn, sum(np) OVER w AS tp, sum(nn) OVER w AS fp, sum(np) OVER (PARTITION BY fold) AS pp,
               sum(nn) OVER (PARTITION BY fold) AS nneg FROM per WINDOW w AS (PARTITION BY fold ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
t AS (SELECT fold, tp, fp, tp - np AS tp0, fp - nn AS fp0, pp, nneg, tp / (tp + fp) AS prec FROM cum),
t2 AS (SELECT *, CASE WHEN tp0 + fp0 = 0 THEN prec ELSE tp0 / (tp0 + fp0) END AS prec0 FROM t),
a AS (SELECT fold,
        sum(CASE WHEN nneg = 0 THEN 0.0 ELSE (fp - fp0) / nneg END * CASE WHEN pp = 0 THEN 0.0 ELSE (tp + tp0) / (2.0 * pp) END) AS roc_auc,
        sum(CASE WHEN pp = 0 THEN 0.0 ELSE (tp - tp0) / pp END * (prec + prec0) / 2) AS pr_auc,
        sum(CASE WHEN pp = 0 THEN 0.0 ELSE (tp - tp0) / pp END * prec) AS average_precision FROM t2 GROUP BY fold)
SELECT m2.fold, tp, fp, fn, tn, round(p1, {R6}) AS precision, round(r1, {R6}) AS recall, round(f11, {R6}) AS f1_pos,
       round(f2, {R6}) AS f2_pos, round(CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE ((tp + fn) * f11 + (tn + fp) * f10) / (tp + fp + fn + tn) END, {R6}) AS f1_weighted,
       round(CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END, {R6}) AS accuracy,
       round(roc_auc, {R6}) AS roc_auc, round(pr_auc, {R6}) AS pr_auc, round(average_precision, {R6}) AS average_precision
FROM m2 JOIN a ON m2.fold = a.fold""", "orders_scored")


_MET_COLS = ["precision", "recall", "f1_pos", "f2_pos", "f1_weighted", "accuracy", "roc_auc", "pr_auc", "average_precision"]


def _metrics(spark, d, inclusive: bool):
    s = fixture(spark, d, "orders_scored").withColumn("pred", N.classify("score", 0.5, inclusive=inclusive))
    m = EV.classification_metrics(s, "y", "pred", "score", by="fold")
    return m.select("fold", "tp", "fp", "fn", "tn", *[F.round(c, R6).alias(c) for c in _MET_COLS])


@register("e13_classification_metrics", _metrics_sql(">="))
def q_e13(spark, d):
    return _metrics(spark, d, True)


@register("e14_sklearn_metrics", _metrics_sql(">"))
def q_e14(spark, d):
    return _metrics(spark, d, False)


_TH_VALUES = ", ".join(f"({i}, {t!r})" for i, t in enumerate(SWEEP_THRESHOLDS))


@register("e15_threshold_sweep", with_fixtures(f"""
WITH th AS (SELECT * FROM (VALUES {_TH_VALUES}) v(i, threshold)),
c AS (SELECT fold, i, threshold, count(*) FILTER (WHERE score >= threshold AND y = 1) AS tp,
             count(*) FILTER (WHERE score >= threshold AND y <> 1) AS fp, count(*) FILTER (WHERE score < threshold AND y = 1) AS fn
      FROM orders_scored, th GROUP BY fold, i, threshold),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM c),
m2 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1, CASE WHEN p + r = 0 THEN 0.0 ELSE 5 * p * r / (4 * p + r) END AS f2 FROM m)
SELECT fold, threshold, tp, fp, fn, round(p, {R6}) AS precision, round(r, {R6}) AS recall, round(f1, {R6}) AS f1, round(f2, {R6}) AS f2,
       CAST(row_number() OVER (PARTITION BY fold ORDER BY f2 DESC, i) = 1 AS INTEGER) AS is_best FROM m2""", "orders_scored"))
def q_e15(spark, d):
    s = fixture(spark, d, "orders_scored")
    r = EV.threshold_sweep(s, "y", "score", SWEEP_THRESHOLDS, by="fold")
    return r.select("fold", "threshold", "tp", "fp", "fn", *[F.round(c, R6).alias(c) for c in ("precision", "recall", "f1", "f2")],
                    "is_best")


# ---------------------------------------------------------------- E16-E18 on a metric log

_WIDE_SQL = ("SELECT fold, step, floor(avg(is_f) * 2 * 100 + 0.5) / 100 AS val_pr_auc, "
             "floor(avg(is_fo) * 100 + 0.5) / 100 AS train_pr_auc FROM orders_metrics GROUP BY fold, step")


def _wide(spark, d):
    m = fixture(spark, d, "orders_metrics")
    return m.groupBy("fold", "step").agg((F.floor(F.avg("is_f") * 2 * 100 + 0.5) / 100).alias("val_pr_auc"),
                                         (F.floor(F.avg("is_fo") * 100 + 0.5) / 100).alias("train_pr_auc"))


@register("e16_best_step", with_fixtures(f"""
WITH RECURSIVE w AS ({_WIDE_SQL}),
m AS (SELECT fold, step, val_pr_auc AS v, row_number() OVER (PARTITION BY fold ORDER BY step) AS i FROM w),
r(fold, i, best, bs, wait, done, last, seen) AS (
  SELECT fold, i, v, step, 0, 0 >= {EARLY_STOP_PATIENCE}, step, 1 FROM m WHERE i = 1
  UNION ALL
  SELECT m.fold, m.i, CASE WHEN m.v > r.best + {EARLY_STOP_MIN_DELTA!r} THEN m.v ELSE r.best END,
         CASE WHEN m.v > r.best + {EARLY_STOP_MIN_DELTA!r} THEN m.step ELSE r.bs END,
         CASE WHEN m.v > r.best + {EARLY_STOP_MIN_DELTA!r} THEN 0 ELSE r.wait + 1 END,
         CASE WHEN m.v > r.best + {EARLY_STOP_MIN_DELTA!r} THEN 0 ELSE r.wait + 1 END >= {EARLY_STOP_PATIENCE},
         m.step, r.seen + 1
  FROM r JOIN m ON m.fold = r.fold AND m.i = r.i + 1 WHERE NOT r.done)
SELECT fold, bs AS best_step, best AS best_value, last AS stop_step, seen AS steps_seen
FROM r WHERE i = (SELECT max(i) FROM r r2 WHERE r2.fold = r.fold)""", "orders_metrics"))
def q_e16(spark, d):
    w = _wide(spark, d).select("fold", "step", F.col("val_pr_auc").alias("value"))
    return EV.best_step(w, patience=EARLY_STOP_PATIENCE, min_delta=EARLY_STOP_MIN_DELTA)


_SUMMARY_SQL = f"""
WITH w AS ({_WIDE_SQL}),
b AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY val_pr_auc DESC, step) AS rn FROM w)
SELECT fold, val_pr_auc AS best_val_pr_auc, step, train_pr_auc FROM b WHERE rn = 1"""


@register("e18_fold_summary", with_fixtures(_SUMMARY_SQL, "orders_metrics"))
def q_e18(spark, d):
    return EV.fold_summary(_wide(spark, d), "fold", "val_pr_auc", ["step", "train_pr_auc"])


@register("e17_gap_report", with_fixtures(f"""
WITH s AS ({_SUMMARY_SQL.replace('WITH w AS', 'WITH w2 AS').replace('FROM w)', 'FROM w2)')})
SELECT fold, best_val_pr_auc, step, train_pr_auc, round(train_pr_auc - best_val_pr_auc, {R6}) AS gap,
       CAST(train_pr_auc - best_val_pr_auc > {OVERFIT_GAP!r} AS INTEGER) AS overfit,
       CAST(best_val_pr_auc > {BASELINE_PR_AUC!r} AS INTEGER) AS beats_baseline FROM s""", "orders_metrics"))
def q_e17(spark, d):
    s = EV.fold_summary(_wide(spark, d), "fold", "val_pr_auc", ["step", "train_pr_auc"])
    r = EV.gap_report(s, "train_pr_auc", "best_val_pr_auc", BASELINE_PR_AUC, OVERFIT_GAP)
    return r.withColumn("gap", F.round("gap", R6))
