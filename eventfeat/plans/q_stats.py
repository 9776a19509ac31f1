"""Queries for graph features (A1-A3, J9), profiles and audits (A4-A12), fitted
transforms (X9, X11) and scored-table scalars (X14, X15)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventfeat.functions import numeric as N
from eventfeat.operators import graph as G
from eventfeat.operators import profile as P
from eventfeat.operators.evaluate import focal_mean
from eventfeat.operators.joins import enrich_roles
from eventfeat.plans.fixtures import fixture, with_fixtures
from eventfeat.plans.registry import register
from eventfeat.plans.tables import Tables

R6 = 6
PR_ALPHA, PR_TOL = 0.85, 1.0e-6

# ---------------------------------------------------------------- graph A1-A3, J9

_EDGE_FACTS = """
SELECT s.s_nationkey AS src, c.c_nationkey AS dst
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey"""


def _edge_facts(spark, d):
    t = Tables(spark, d)
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
            .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
            .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
            .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"))


def _edges(spark, d):
    return G.edge_weights(_edge_facts(spark, d), "s_nationkey", "c_nationkey")


_EDGES_SQL = f"SELECT src, dst, count(*) AS weight FROM ({_EDGE_FACTS}) f GROUP BY src, dst"


@register("a1_edge_weights", _EDGES_SQL)
def q_a1(spark, d):
    return _edges(spark, d)


_DEG_SQL = f"""
WITH e AS ({_EDGES_SQL}),
     i AS (SELECT dst AS node, CAST(sum(weight) AS DOUBLE) AS in_degree FROM e GROUP BY dst),
     o AS (SELECT src AS node, CAST(sum(weight) AS DOUBLE) AS out_degree FROM e GROUP BY src)
SELECT coalesce(i.node, o.node) AS node, coalesce(in_degree, 0.0) AS in_degree, coalesce(out_degree, 0.0) AS out_degree
FROM i FULL OUTER JOIN o ON i.node = o.node"""


@register("a2_weighted_degrees", _DEG_SQL)
def q_a2(spark, d):
    return G.weighted_degrees(_edges(spark, d))


def _pagerank_sql(edges_sql: str) -> str:
    """Power iteration that recurs until the L1 change is below N * tol."""
    a = PR_ALPHA
    return f"""
WITH RECURSIVE e AS MATERIALIZED ({edges_sql}),
ow AS MATERIALIZED (SELECT src, sum(weight) AS ow FROM e GROUP BY src),
en AS MATERIALIZED (SELECT e.src, e.dst, CAST(e.weight AS DOUBLE) / ow.ow AS p FROM e JOIN ow ON e.src = ow.src),
nd AS MATERIALIZED (SELECT node, node NOT IN (SELECT src FROM ow) AS dangling FROM (SELECT src AS node FROM e UNION SELECT dst FROM e)),
nn AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nd),
steps AS (SELECT 0 AS it, nd.node, nd.dangling, 1.0::DOUBLE / nn.n AS r, CAST('inf' AS DOUBLE) AS err FROM nd, nn
  UNION ALL
  SELECT it, node, dangling, r, sum(abs(r - old)) OVER () AS err FROM (
    SELECT p.it + 1 AS it, p.node, p.dangling, p.r AS old, {a!r} * (coalesce(c.s, 0) + p.dm / nn.n) + {1 - a!r} / nn.n AS r
    FROM (SELECT *, sum(CASE WHEN dangling THEN r ELSE 0 END) OVER () AS dm FROM steps) p
    LEFT JOIN (SELECT en.dst AS node, sum(q.r * en.p) AS s FROM en JOIN steps q ON en.src = q.node GROUP BY en.dst) c ON p.node = c.node, nn
    WHERE p.err >= nn.n * {PR_TOL!r}) x)
SELECT node, round(r, {R6}) AS pagerank FROM steps WHERE it = (SELECT max(it) FROM steps)"""


@register("a3_pagerank", _pagerank_sql(_EDGES_SQL))
def q_a3(spark, d):
    pr = G.pagerank(_edges(spark, d), alpha=PR_ALPHA, tol=PR_TOL)
    return pr.select("node", F.round("pagerank", R6).alias("pagerank"))


_PATHS_SQL = """SELECT src, dst, 1 AS weight FROM (SELECT c_custkey AS src,
  lead(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS dst FROM customer) p WHERE dst IS NOT NULL"""


@register("a3_pagerank_paths", _pagerank_sql(_PATHS_SQL))
def q_a3_paths(spark, d):
    """Each nation's customers as one path: rank walks down it for many steps."""
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    paths = Tables(spark, d).customer.select(F.col("c_custkey").alias("src"), F.lead("c_custkey").over(w).alias("dst"), F.lit(1).alias("weight"))
    pr = G.pagerank(paths.filter("dst IS NOT NULL"), alpha=PR_ALPHA, tol=PR_TOL)
    return pr.select("node", F.round("pagerank", R6).alias("pagerank"))


@register("j9_node_metrics_roles", f"""
WITH pr AS ({_pagerank_sql(_EDGES_SQL)}), dg AS ({_DEG_SQL}),
     f AS (SELECT l.l_orderkey, l.l_linenumber, s.s_nationkey AS src, c.c_nationkey AS dst
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
           JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT f.l_orderkey, f.l_linenumber, p1.pagerank AS src_pagerank, d1.out_degree AS src_out_degree,
       p2.pagerank AS dst_pagerank, d2.in_degree AS dst_in_degree
FROM f LEFT JOIN pr p1 ON f.src = p1.node LEFT JOIN dg d1 ON f.src = d1.node
LEFT JOIN pr p2 ON f.dst = p2.node LEFT JOIN dg d2 ON f.dst = d2.node""")
def q_j9(spark, d):
    facts = _edge_facts(spark, d).select("l_orderkey", "l_linenumber", "s_nationkey", "c_nationkey")
    # note: (l_orderkey, l_linenumber) repeats in lineitem; rows are kept as they are
    m = G.node_metrics(_edges(spark, d), alpha=PR_ALPHA, tol=PR_TOL).withColumn("pagerank", F.round("pagerank", R6))
    out = enrich_roles(facts, m, "node", {"src_": "s_nationkey", "dst_": "c_nationkey"})
    return out.select("l_orderkey", "l_linenumber", "src_pagerank", "src_out_degree", "dst_pagerank", "dst_in_degree")


# ---------------------------------------------------------------- A4-A12

@register("a4_time_span", "SELECT min(o_orderdate) AS min_time, max(o_orderdate) AS max_time FROM orders")
def q_a4(spark, d):
    return P.time_span(Tables(spark, d).orders, "o_orderdate")


_NULL_COLS = ["o_custkey", "o_totalprice", "o_orderpriority", "o_rate"]


@register("a5_null_profile", with_fixtures(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), {R6}) AS null_pct FROM orders_dirty"
    for c in _NULL_COLS), "orders_dirty"))
def q_a5(spark, d):
    r = P.null_profile(fixture(spark, d, "orders_dirty"), _NULL_COLS)
    return r.withColumn("null_pct", F.round("null_pct", R6))


@register("a6_leakage_audit", """
WITH k AS (SELECT l_orderkey, max(l_shipdate) AS known_at FROM lineitem GROUP BY l_orderkey),
     o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice - 250000 AS v, k.known_at
           FROM orders LEFT JOIN k ON o_orderkey = k.l_orderkey),
     l AS (SELECT *, lag(v) OVER w AS pv, lag(known_at) OVER w AS pk FROM o
           WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
     g AS (SELECT CASE WHEN epoch(pk) < epoch(o_orderdate) - 3661 AND pv >= 0 THEN pv END AS prev_v_clean,
                  CASE WHEN epoch(pk) < epoch(o_orderdate) - 3661 THEN 1 END AS gap_known_min,
                  (epoch(o_orderdate) - epoch(pk)) / 3600.0 AS gap_known_h FROM l)
SELECT count(*) FILTER (WHERE gap_known_h < 3661 / 3600.0 AND prev_v_clean IS NOT NULL) AS prev_v_clean_violations,
       count(*) FILTER (WHERE gap_known_h < 3661 / 3600.0 AND gap_known_min IS NOT NULL) AS gap_known_min_violations,
       count(*) FILTER (WHERE gap_known_h < 3661 / 3600.0) AS at_risk_rows, count(*) AS total_rows FROM g""")
def q_a6(spark, d):
    from eventfeat.plans.q_core import _safe_lag_df
    return P.leakage_audit(_safe_lag_df(spark, d, bucket_s=180 * 86400), "gap_known_h", 3661 / 3600.0,
                           ["prev_v_clean", "gap_known_min"])


@register("a7_median", "SELECT 'o_totalprice' AS col, quantile_disc(o_totalprice, 0.5) AS median FROM orders "
          "UNION ALL SELECT 'l_extendedprice', quantile_disc(l_extendedprice, 0.5) FROM lineitem")
def q_a7(spark, d):
    t = Tables(spark, d)
    found = [(c, P.fit_median(x, c)) for x, c in ((t.orders, "o_totalprice"), (t.lineitem, "l_extendedprice"))]
    return spark.createDataFrame(found, "col string, median double")


_SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a8_skew_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5), {R6}) AS skewness "
    f"FROM lineitem, (SELECT avg({c}) AS m FROM lineitem) mm" for c in _SKEW_COLS))
def q_a8(spark, d):
    r = P.skew_profile(Tables(spark, d).lineitem, _SKEW_COLS)
    return r.withColumn("skewness", F.round("skewness", R6))


@register("a9_split_stats", f"""
WITH s AS (SELECT CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' THEN 'train'
                       WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' THEN 'test' END AS split
           FROM orders)
SELECT split, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), {R6}) AS share FROM s
WHERE split IS NOT NULL GROUP BY split""")
def q_a9(spark, d):
    from eventfeat.operators.split import horizon_split
    s = horizon_split(Tables(spark, d).orders, "o_orderdate", "1995-01-01", 48, 12)
    return P.split_stats(s).withColumn("share", F.round("share", R6))


@register("a10_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
          "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def q_a10(spark, d):
    return P.duplicate_keys(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@register("a10_duplicate_summary", """
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows
FROM lineitem""")
def q_a10s(spark, d):
    return P.duplicate_summary(Tables(spark, d).lineitem)


@register("a11_distinct_values", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def q_a11(spark, d):
    return P.distinct_values(Tables(spark, d).lineitem, ["l_suppkey", "l_returnflag"])


@register("a12_class_balance", with_fixtures(f"""
SELECT fold, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, round(avg(y), {R6}) AS pos_rate,
       round(least(0.85, greatest(0.5, 1 - avg(y))), {R6}) AS alpha
FROM orders_scored GROUP BY fold""", "orders_scored"))
def q_a12(spark, d):
    r = P.class_balance(fixture(spark, d, "orders_scored"), "y", by=["fold"])
    return r.withColumn("pos_rate", F.round("pos_rate", R6)).withColumn("alpha", F.round("alpha", R6))


# ---------------------------------------------------------------- X9 fitted signed log

_X9_COLS = ["value", "event_id", "user_id", "value_sq"]
_X9_BASE = "SELECT event_id, ts, value, user_id, value * value / 100 AS value_sq FROM events"


def _x9_frame(spark, d):
    return Tables(spark, d).events.selectExpr("event_id", "ts", "value", "user_id", "value * value / 100 AS value_sq")


def _x9_fit(spark, d):
    base = _x9_frame(spark, d)
    train = base.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return base, P.fit_skew_log(train, _X9_COLS, threshold=1.0)


_X9_SKEW_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS sk "
    f"FROM b, (SELECT avg({c}) AS m FROM b) mm" for c in _X9_COLS)


@register("x9_skew_log_fit", f"""
WITH b AS ({_X9_BASE} WHERE ts < TIMESTAMP '2024-01-20'), s AS ({_X9_SKEW_SQL})
SELECT s."column", round(sk, {R6}) AS skewness, CASE WHEN abs(sk) > 1.0 THEN 1 ELSE 0 END AS logged FROM s""")
def q_x9f(spark, d):
    base = _x9_frame(spark, d)
    train = base.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    sk = P.skew_profile(train, _X9_COLS)
    return sk.select("column", F.round("skewness", R6).alias("skewness"),
                     (F.abs("skewness") > 1.0).cast("int").alias("logged"))


@register("x9_skew_log_apply", f"""
WITH b AS ({_X9_BASE} WHERE ts < TIMESTAMP '2024-01-20'), s AS ({_X9_SKEW_SQL}), a AS ({_X9_BASE}),
     long AS ({" UNION ALL ".join(f"SELECT event_id, '{c}' AS column, sign({c}) * ln(1 + abs({c})) AS v FROM a" for c in _X9_COLS)})
SELECT event_id, long.column, round(v, {R6}) AS value_log FROM long JOIN s ON long.column = s.column WHERE abs(s.sk) > 1.0""")
def q_x9a(spark, d):
    base, fit = _x9_fit(spark, d)
    out = fit.apply(base)
    if not fit.cols:
        return spark.createDataFrame([], "event_id long, column string, value_log double")
    stack = ", ".join(f"'{c}', `{c}_log`" for c in fit.cols)
    return out.selectExpr("event_id", f"stack({len(fit.cols)}, {stack}) as (column, value_log)").withColumn(
        "value_log", F.round("value_log", R6))


# ---------------------------------------------------------------- X11 null policy

@register("x11_null_policy", with_fixtures("""
WITH m AS (SELECT quantile_disc(o_totalprice, 0.5) AS med FROM orders_dirty WHERE o_orderdate < TIMESTAMP '1999-01-01')
SELECT o_orderkey, coalesce(o_custkey, 0) AS o_custkey, coalesce(o_totalprice, m.med) AS o_totalprice,
       coalesce(o_rate, 29.92) AS o_rate, coalesce(o_orderpriority, 'UNKNOWN') AS o_orderpriority
FROM orders_dirty, m""", "orders_dirty"))
def q_x11(spark, d):
    df = fixture(spark, d, "orders_dirty")
    train = df.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    pol = P.fit_null_policy(train, zero=["o_custkey", "missing_col"], median=["o_totalprice"],
                            const={"o_rate": 29.92, "o_orderpriority": "UNKNOWN"})
    return pol.apply(df).select("o_orderkey", "o_custkey", "o_totalprice", "o_rate", "o_orderpriority")


# ---------------------------------------------------------------- X14 / X15

def _focal_sql(alpha: float, gamma: float) -> str:
    pc = "least(greatest(score, 1e-12), 1 - 1e-12)"
    return (f"avg(({alpha!r} * y + {1 - alpha!r} * (1 - y)) * pow(1 - (score * y + (1 - score) * (1 - y)), {gamma!r})"
            f" * -(y * ln({pc}) + (1 - y) * ln(1 - {pc})))")


@register("x14_focal_loss", with_fixtures(f"""
SELECT fold, round({_focal_sql(0.75, 2.0)}, {R6}) AS focal_loss, round({_focal_sql(0.75, 1.0)}, {R6}) AS focal_loss_g1,
       count(*) AS rows FROM orders_scored GROUP BY fold""", "orders_scored"))
def q_x14(spark, d):
    s = fixture(spark, d, "orders_scored")
    a = focal_mean(s, "y", p="score", alpha=0.75, gamma=2.0, by="fold")
    b = focal_mean(s, "y", p="score", alpha=0.75, gamma=1.0, by="fold").select("fold", F.col("focal_loss").alias("focal_loss_g1"))
    return a.join(b, "fold").select("fold", F.round("focal_loss", R6).alias("focal_loss"),
                                    F.round("focal_loss_g1", R6).alias("focal_loss_g1"), "rows")


@register("x15_classify", with_fixtures("""
SELECT o_orderkey, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred_ge, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred_gt
FROM orders_scored""", "orders_scored"))
def q_x15(spark, d):
    s = fixture(spark, d, "orders_scored")
    return s.select("o_orderkey", N.classify("score", 0.5).alias("pred_ge"), N.classify("score", 0.5, inclusive=False).alias("pred_gt"))
