"""Queries for projections/filters (F), joins (J) and sequence windows (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventfeat.functions import numeric as N
from eventfeat.functions import timecols as TC
from eventfeat.operators import clean as C
from eventfeat.operators import joins as J
from eventfeat.operators import sequence as S
from eventfeat.operators.asof import asof_join, match_rate, nearest_per_key
from eventfeat.operators.zones import zone_containing
from eventfeat.plans.fixtures import fixture, with_fixtures
from eventfeat.plans.presets import us_holidays
from eventfeat.plans.registry import register
from eventfeat.plans.tables import Tables

HOUR = 3600
R6 = 6  # decimals kept on computed doubles in every query and oracle

# ---------------------------------------------------------------- J7 / J8 as-of

_ASOF_SQL = """
WITH p AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase'),
     v AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'view'),
     j AS (
       SELECT p.event_id, p.ts, p.user_id, p.value, p.ts - INTERVAL 1 HOUR AS asof_target_ts,
              v.ts AS vts, v.event_id AS veid, v.value AS vval
       FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts - INTERVAL 1 HOUR >= v.ts)
SELECT event_id, ts, user_id, value, asof_target_ts,
       CASE WHEN vts >= asof_target_ts - INTERVAL 8 HOUR THEN vts END AS matched_ts,
       CASE WHEN vts >= asof_target_ts - INTERVAL 8 HOUR THEN veid END AS view_event_id,
       CASE WHEN vts >= asof_target_ts - INTERVAL 8 HOUR THEN vval END AS view_value
FROM j
"""


def purchase_view_asof(spark, sf_dir, bucket_s=None):
    t = Tables(spark, sf_dir)
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    purchases = ev.filter(F.col("event_type") == "purchase").drop("event_type")
    views = ev.filter(F.col("event_type") == "view").select("user_id", "ts", "event_id", "value")
    return asof_join(purchases, views, "user_id", "ts", "ts", offset_s=1 * HOUR, tolerance_s=8 * HOUR,
                     right_cols=["event_id", "value"], tiebreak="event_id", prefix="view_", bucket_s=bucket_s)


@register("j7_asof_join", _ASOF_SQL)
def q_j7(spark, d):
    return purchase_view_asof(spark, d)


@register("j7_asof_join_wide_buckets", _ASOF_SQL)
def q_j7_wide(spark, d):
    # same result with 3-day buckets (carry from the previous bucket only)
    return purchase_view_asof(spark, d, bucket_s=72 * HOUR)


@register("j8_match_rate", f"SELECT count(matched_ts) AS matched, count(*) AS total FROM ({_ASOF_SQL}) a")
def q_j8(spark, d):
    return match_rate(purchase_view_asof(spark, d), "matched_ts")


# ---------------------------------------------------------------- F1-F11

@register("f1_keep", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def q_f1(spark, d):
    return C.keep(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber", "l_quantity", "l_orderkey", "l_shipdate"])


@register("f2_between_dates", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders "
          "WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'")
def q_f2(spark, d):
    return C.between_dates(Tables(spark, d).orders, "o_orderdate", "1996-01-01", "1997-12-31").select(
        "o_orderkey", "o_custkey", "o_orderdate")


@register("f3_exclude", "SELECT l_orderkey, l_linenumber, l_returnflag, l_suppkey FROM lineitem "
          "WHERE l_linestatus = 'F' AND l_returnflag NOT IN ('R') AND l_suppkey NOT IN (1, 2, 3, 5, 8, 13)")
def q_f3(spark, d):
    li = Tables(spark, d).lineitem
    return C.exclude(li, equals={"l_linestatus": "F"}, not_in={"l_returnflag": ["R"], "l_suppkey": [1, 2, 3, 5, 8, 13]}).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")


@register("f4_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def q_f4(spark, d):
    return C.contains(Tables(spark, d).part, "p_name", "ring").select("p_partkey", "p_name")


@register("f5_require", "SELECT c_custkey, c_mktsegment FROM customer "
          "WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL AND length(c_mktsegment) = 8")
def q_f5(spark, d):
    return C.require(Tables(spark, d).customer, ["c_name", "c_acctbal"], {"c_mktsegment": 8}).select("c_custkey", "c_mktsegment")


@register("f6_restrict_to", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA')""")
def q_f6(spark, d):
    t = Tables(spark, d)
    keys = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .filter(F.col("r_name") == "AMERICA").select("c_custkey"))
    return C.restrict_to(t.orders, keys, {"o_custkey": "c_custkey"}).select("o_orderkey", "o_custkey", "o_totalprice")


@register("f7_compose_key", """
SELECT l_orderkey, l_linenumber,
  concat_ws('_', coalesce(CAST(CAST(l_shipdate AS DATE) AS STRING), ''), coalesce(lpad(CAST(l_linenumber AS STRING), 4, '0'), ''),
            coalesce(CAST(CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_suppkey END AS STRING), ''), coalesce(CAST(l_orderkey AS STRING), '')) AS row_key,
  concat_ws('_', CAST(CAST(l_shipdate AS DATE) AS STRING), lpad(CAST(l_linenumber AS STRING), 4, '0'),
            CAST(CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_suppkey END AS STRING), CAST(l_orderkey AS STRING)) AS row_key_compat
FROM lineitem""")
def q_f7(spark, d):
    li = Tables(spark, d).lineitem.withColumn(
        "supp", F.when(F.col("l_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("l_suppkey")))
    parts = [F.to_date("l_shipdate"), "l_linenumber", "supp", "l_orderkey"]
    return li.select("l_orderkey", "l_linenumber", C.compose_key(parts, {1: 4}).alias("row_key"),
                     C.compose_key(parts, {1: 4}, null_token=None).alias("row_key_compat"))


@register("f8_dedup", "SELECT DISTINCT * FROM orders")
def q_f8(spark, d):
    o = Tables(spark, d).orders
    return C.dedup(o.unionByName(o))


@register("f9_time_slice", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem "
          "WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'")
def q_f9(spark, d):
    return C.time_slice(Tables(spark, d).lineitem, "l_shipdate", "1997-01-01", "1998-01-01").select(
        "l_orderkey", "l_linenumber", "l_shipdate")


@register("f10_with_prefix", "SELECT n_nationkey AS cust_n_nationkey, n_name AS cust_n_name FROM nation")
def q_f10(spark, d):
    return C.with_prefix(Tables(spark, d).nation, "cust_", drop=["cust_n_regionkey"])


@register("f11_coerce", with_fixtures(
    "SELECT o_orderkey, TRY_CAST(price_str AS DOUBLE) AS price_str, TRY_CAST(prio_str AS INTEGER) AS prio_str "
    "FROM orders_dirty", "orders_dirty"))
def q_f11(spark, d):
    df = fixture(spark, d, "orders_dirty").select("o_orderkey", "price_str", "prio_str")
    return C.coerce(df, {"price_str": "double", "prio_str": "int", "not_there": "int"})


@register("f12_bucketize", with_fixtures("""
SELECT event_id, degrees,
  CASE WHEN degrees IS NULL OR degrees = 0 OR degrees = 360 THEN 'Calm'
       WHEN degrees >= 337.5 OR degrees < 22.5 THEN 'N' WHEN degrees < 67.5 THEN 'NE'
       WHEN degrees < 112.5 THEN 'E' WHEN degrees < 157.5 THEN 'SE' WHEN degrees < 202.5 THEN 'S'
       WHEN degrees < 247.5 THEN 'SW' WHEN degrees < 292.5 THEN 'W' WHEN degrees < 337.5 THEN 'NW'
       ELSE 'OTHER' END AS wind_dir
FROM ev_clock""", "ev_clock"))
def q_f12(spark, d):
    return fixture(spark, d, "ev_clock").select("event_id", "degrees", N.compass("degrees").alias("wind_dir"))


@register("f13_hour_block", with_fixtures(
    "SELECT event_id, crs_dep, format('{:02d}00-{:02d}59', CAST(floor(crs_dep / 100) AS INT), "
    "CAST(floor(crs_dep / 100) AS INT)) AS dep_block FROM ev_clock", "ev_clock"))
def q_f13(spark, d):
    return fixture(spark, d, "ev_clock").select("event_id", "crs_dep", TC.hour_block("crs_dep").alias("dep_block"))


# ---------------------------------------------------------------- J1 / J1x calendar

CAL_YEARS = (1994, 2002)


def _cal_values() -> str:
    rows = ", ".join(f"(DATE '{d}', '{n.replace(chr(39), chr(39) * 2)}')" for d, n in us_holidays(*CAL_YEARS))
    return f"(SELECT * FROM (VALUES {rows}) v(holiday_date, holiday_name))"


def _calendar(spark):
    from eventfeat.sources.io import literal_table
    return literal_table(spark, us_holidays(*CAL_YEARS), "holiday_date string, holiday_name string").select(
        F.to_date("holiday_date").alias("holiday_date"), "holiday_name")


@register("j1_near_date_flag", f"""
SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM {_cal_values()} c
        WHERE abs(date_diff('day', c.holiday_date, CAST(o.o_orderdate AS DATE))) <= 2) THEN 1 ELSE 0 END AS IS_US_HOLIDAY
FROM orders o""")
def q_j1(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return J.near_date_flag(o, _calendar(spark), "o_orderdate").drop("o_orderdate")


@register("j1x_near_date_join", f"""
SELECT o_orderkey, c.holiday_date, c.holiday_name, CASE WHEN c.holiday_date IS NULL THEN 0 ELSE 1 END AS IS_US_HOLIDAY
FROM orders o LEFT JOIN {_cal_values()} c ON abs(date_diff('day', c.holiday_date, CAST(o.o_orderdate AS DATE))) <= 2""")
def q_j1x(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return J.near_date_join(o, _calendar(spark), "o_orderdate").drop("o_orderdate")


# ---------------------------------------------------------------- J2-J6, J9-J11

@register("j2_inner", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def q_j2(spark, d):
    t = Tables(spark, d)
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.inner_enrich(t.orders.select("o_orderkey", "o_custkey"), cust, "o_custkey").drop("o_custkey")


_NEAREST_SQL = f"""
SELECT c_custkey, s_suppkey, s_acctbal, round(dist, {R6}) AS distance FROM (
  SELECT c.c_custkey, s.s_suppkey, s.s_acctbal, abs(c.c_acctbal - s.s_acctbal) AS dist,
         row_number() OVER (PARTITION BY c.c_custkey ORDER BY abs(c.c_acctbal - s.s_acctbal), s.s_suppkey) AS rn
  FROM customer c LEFT JOIN supplier s ON c.c_nationkey = s.s_nationkey) x
WHERE rn = 1"""


def _nearest(spark, d, bucket=None):
    t = Tables(spark, d)
    r = nearest_per_key(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"),
                        t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"),
                        by="c_nationkey", left_value="c_acctbal", cand_value="s_acctbal", cand_id="s_suppkey",
                        cand_by="s_nationkey", cand_cols=["s_suppkey", "s_acctbal"], bucket_width=bucket)
    return r.select("c_custkey", "s_suppkey", "s_acctbal", F.round("distance", R6).alias("distance"))


@register("j3_nearest_per_key", _NEAREST_SQL)
def q_j3(spark, d):
    # balance buckets of 100: a nation (25 keys) is spread over ~110 tasks; carry-in
    # from the nearest non-empty bucket on each side keeps the answer exact
    return _nearest(spark, d, bucket=100.0)


@register("j3_nearest_per_key_bucketed", _NEAREST_SQL)
def q_j3b(spark, d):
    return _nearest(spark, d, bucket=500.0)


@register("j4_enrich_roles", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, cn.n_name AS cust_n_name, cn.n_regionkey AS cust_n_regionkey,
       sn.n_name AS supp_n_name, sn.n_regionkey AS supp_n_regionkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey""")
def q_j4(spark, d):
    t = Tables(spark, d)
    f = (t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
         .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
         .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
         .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey"))
    out = J.enrich_roles(f, t.nation, "n_nationkey", {"cust_": "c_nationkey", "supp_": "s_nationkey"})
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "cust_n_name", "cust_n_regionkey",
                      "supp_n_name", "supp_n_regionkey")


@register("j5_enrich_fallback", """
SELECT c.c_custkey, coalesce(p.n_name, b.n_name) AS n_name, coalesce(p.n_regionkey, b.n_regionkey) AS n_regionkey
FROM customer c
LEFT JOIN (SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey % 3 <> 0) p ON c.c_nationkey = p.n_nationkey
LEFT JOIN (SELECT n_nationkey, n_name || '_bk' AS n_name, n_regionkey FROM nation) b ON c.c_nationkey = b.n_nationkey""")
def q_j5(spark, d):
    t = Tables(spark, d)
    primary = t.nation.filter(F.col("n_nationkey") % 3 != 0)
    backup = t.nation.withColumn("n_name", F.concat("n_name", F.lit("_bk")))
    out = J.enrich_with_fallback(t.customer.select("c_custkey", "c_nationkey"), primary, backup,
                                 "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"])
    return out.select("c_custkey", "n_name", "n_regionkey")


@register("j6_semi_prune", "SELECT event_id, user_id FROM events WHERE user_id IN "
          "(SELECT user_id FROM events WHERE event_type = 'purchase')")
def q_j6(spark, d):
    ev = Tables(spark, d).events
    buyers = ev.filter(F.col("event_type") == "purchase").select("user_id").distinct()
    return C.restrict_to(ev.select("event_id", "user_id"), buyers, "user_id")


_TE_SQL = f"""
WITH tr AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     m AS (SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS te FROM tr GROUP BY o_custkey),
     g AS (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS gm FROM tr)
SELECT o.o_orderkey, round(coalesce(m.te, g.gm), {R6}) AS o_custkey_te
FROM orders o LEFT JOIN m ON o.o_custkey = m.o_custkey, g
WHERE o.o_orderdate >= TIMESTAMP '1999-01-01'"""


@register("j10_target_encoding", _TE_SQL)
def q_j10(spark, d):
    o = Tables(spark, d).orders.withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    train = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    test = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    enc = J.fit_target_encoding(train, "o_custkey", "y")
    return enc.apply(test).select("o_orderkey", F.round("o_custkey_te", R6).alias("o_custkey_te"))


# --- fixed values: reference points (lat, lon) with their IANA zone, for J11
ZONE_POINTS = [
    (1, "America/New_York", 40.7128, -74.0060), (2, "America/Chicago", 41.8781, -87.6298),
    (3, "America/Denver", 39.7392, -104.9903), (4, "America/Los_Angeles", 34.0522, -118.2437),
    (5, "America/Anchorage", 61.2181, -149.9003), (6, "Pacific/Honolulu", 21.3069, -157.8583),
    (7, "Europe/London", 51.5074, -0.1278), (8, "Asia/Tokyo", 35.6762, 139.6503),
    (9, "Australia/Sydney", -33.8688, 151.2093), (10, "America/Sao_Paulo", -23.5505, -46.6333),
    (11, "Africa/Johannesburg", -26.2041, 28.0473), (12, "Asia/Kolkata", 28.6139, 77.2090),
]
_D2R = repr(3.141592653589793 / 180.0)


def _zone_values() -> str:
    rows = ", ".join(f"({i}, '{z}', {a}, {b})" for i, z, a, b in ZONE_POINTS)
    return f"(SELECT * FROM (VALUES {rows}) v(zone_id, zone, zone_lat, zone_lon))"


_ZONE_SQL = f"""
WITH p AS (SELECT c_custkey, CAST(trim(split_part(coords, ',', 1)) AS DOUBLE) AS lat,
                  CAST(trim(split_part(coords, ',', 2)) AS DOUBLE) AS lon
           FROM (SELECT c_custkey, CAST(CAST(c_custkey % 170 AS INT) - 85 AS STRING) || ',' ||
                        CAST(CAST((c_custkey * 7) % 360 AS INT) - 180 AS STRING) AS coords FROM customer)),
     d AS (SELECT p.c_custkey, z.zone_id, z.zone,
              {2 * 6371.0088!r} * asin(least(1.0, sqrt(pow(sin((z.zone_lat - p.lat) * {_D2R} / 2), 2)
                + cos(p.lat * {_D2R}) * cos(z.zone_lat * {_D2R}) * pow(sin((z.zone_lon - p.lon) * {_D2R} / 2), 2)))) AS km
           FROM p, {_zone_values()} z),
     b AS (SELECT c_custkey, zone_id, zone, km, row_number() OVER (PARTITION BY c_custkey ORDER BY km, zone_id) AS rn
           FROM d WHERE km <= 1500)
SELECT p.c_custkey, b.zone_id, b.zone, round(b.km, {R6}) AS zone_km
FROM p LEFT JOIN b ON p.c_custkey = b.c_custkey AND b.rn = 1"""


@register("j11_zone_lookup", _ZONE_SQL)
def q_j11(spark, d):
    c = Tables(spark, d).customer
    coords = F.concat_ws(",", ((F.col("c_custkey") % 170).cast("int") - 85).cast("string"),
                         ((F.col("c_custkey") * 7) % 360 - 180).cast("int").cast("string"))
    lat, lon = TC.split_pair(coords)
    pts = c.select("c_custkey", lat.alias("lat"), lon.alias("lon"))
    zones = spark.createDataFrame(ZONE_POINTS, "zone_id int, zone string, zone_lat double, zone_lon double")
    r = J.zone_lookup(pts, zones, "c_custkey", "lat", "lon", max_km=1500.0, cell_deg=10.0)
    return r.select("c_custkey", "zone_id", "zone", F.round("zone_km", R6).alias("zone_km"))


# Zones by containment: an eight-cornered zone around a place of each nation, some with a
# hole, some over the date line; points by event.  All numbers are binary fractions, so
# both engines compute the same borders.
_CORNERS = [(8, 0), (6, 6), (0, 8), (-6, 6), (-8, 0), (-6, -6), (0, -8), (6, -6)]  # fixed values
_HOLE = [(1.25, 1.25), (-1.25, 1.25), (-1.25, -1.25), (1.25, -1.25)]
_CX, _CY = "((n_nationkey * 37) % 360 - 180)", "((n_nationkey * 29) % 120 - 60)"


def _corner_rows() -> list[tuple[str, int, int, str, str]]:
    """(condition, ring, seq, x, y) of each corner as SQL."""
    out = [("n_nationkey >= 0", 0, k, f"CAST({_CX} AS DOUBLE) + {a} * ((n_nationkey * 3 + {k * 5}) % 4 + 1) / 2",
            f"CAST({_CY} AS DOUBLE) + {b} * ((n_nationkey * 3 + {k * 5}) % 4 + 1) / 2") for k, (a, b) in enumerate(_CORNERS)]
    return out + [("n_nationkey % 2 = 0", 1, k, f"CAST({_CX} AS DOUBLE) + CAST({a} AS DOUBLE)", f"CAST({_CY} AS DOUBLE) + CAST({b} AS DOUBLE)")
                  for k, (a, b) in enumerate(_HOLE)]


_POINT = {"lon": "CAST(event_id * 131 % 2881 AS DOUBLE) / 8 - 180", "lat": "CAST(event_id * 73 % 1281 AS DOUBLE) / 8 - 80"}
_CONTAIN_SQL = f"""
WITH v AS ({" UNION ALL ".join(f"SELECT n_nationkey AS zone_id, n_name AS zone, {r} AS ring, {k} AS seq, {x} AS x, {y} AS y FROM nation WHERE {c}" for c, r, k, x, y in _corner_rows())}),
e AS (SELECT zone_id, x AS x1, y AS y1,
        coalesce(lead(x) OVER w, first(x) OVER w) AS x2, coalesce(lead(y) OVER w, first(y) OVER w) AS y2
      FROM v WINDOW w AS (PARTITION BY zone_id, ring ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
p AS (SELECT DISTINCT {_POINT['lon']} AS lon, {_POINT['lat']} AS lat FROM events),
t AS (SELECT lon, lat, CASE WHEN lon = 180 THEN -180 ELSE lon END + s AS x FROM p, (VALUES (-360), (0), (360)) AS v(s)),
h AS (SELECT lon, lat, x, zone_id FROM t JOIN e ON (y1 <= lat) <> (y2 <= lat) AND x < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
      GROUP BY ALL HAVING count(*) % 2 = 1),
z AS (SELECT lon, lat, min(zone_id) AS zone_id FROM h GROUP BY lon, lat)
SELECT event_id, z.zone_id, n_name AS zone
FROM (SELECT event_id, {_POINT['lon']} AS lon, {_POINT['lat']} AS lat FROM events) a
LEFT JOIN z ON a.lon = z.lon AND a.lat = z.lat LEFT JOIN nation ON zone_id = n_nationkey"""


@register("j11_zone_containing", _CONTAIN_SQL)
def q_j11c(spark, d):
    t = Tables(spark, d)
    corner = F.explode(F.array(*[F.when(F.expr(c), F.struct(F.lit(r).alias("ring"), F.lit(k).alias("seq"), F.expr(x).alias("x"), F.expr(y).alias("lat")))
                                 for c, r, k, x, y in _corner_rows()]))
    v = t.nation.select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone"), corner.alias("v")).filter("v IS NOT NULL")
    # longitudes as a map has them, from -180 to 180
    v = v.select("zone_id", "zone", "v.ring", "v.seq", "v.lat", (F.pmod(F.col("v.x") + 180, F.lit(360.0)) - 180).alias("lon"))
    pts = t.events.select("event_id", *[F.expr(e).alias(c) for c, e in _POINT.items()])
    r = zone_containing(pts, v, "lat", "lon", zone_cols=["zone"], cell_deg=5.0)
    return r.select("event_id", "zone_id", "zone")


# ---------------------------------------------------------------- W1-W5

@register("w1_top1", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x
WHERE rn = 1""")
def q_w1(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return S.top1(o, "o_custkey", ["o_orderdate", "o_orderkey"])


_LAG_SQL = """
SELECT o_orderkey,
  lag(o_orderkey) OVER w AS prev_o_orderkey, lag(o_totalprice) OVER w AS prev_o_totalprice,
  lag(o_orderdate) OVER w AS prev_o_orderdate
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""


def _lag(spark, d, bucket_s=None):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = S.lag_features(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice", "o_orderdate"],
                       bucket_s=bucket_s)
    return r.select("o_orderkey", "prev_o_orderkey", "prev_o_totalprice", "prev_o_orderdate")


@register("w2_lag_features", _LAG_SQL)
def q_w2(spark, d):
    # yearly buckets: a hot customer's history is split over many tasks
    return _lag(spark, d, bucket_s=365 * 86400)


@register("w2_lag_features_bucketed", _LAG_SQL)
def q_w2b(spark, d):
    # 90-day buckets: each customer's history is split; earlier buckets carried in
    return _lag(spark, d, bucket_s=90 * 86400)


def _safe_lag_df(spark, d, bucket_s=None):
    t = Tables(spark, d)
    known = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("known_at"))
    o = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate", (F.col("o_totalprice") - 250000).alias("v"))
         .join(known, "o_orderkey", "left"))
    return S.safe_lag(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", "v", "known_at",
                      lead_s=3661, nonneg=True, bucket_s=bucket_s)


_SAFE_SQL = f"""
WITH k AS (SELECT l_orderkey, max(l_shipdate) AS known_at FROM lineitem GROUP BY l_orderkey),
     o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice - 250000 AS v, k.known_at
           FROM orders LEFT JOIN k ON o_orderkey = k.l_orderkey),
     l AS (SELECT *, lag(v) OVER w AS pv, lag(known_at) OVER w AS pk, lag(o_orderdate) OVER w AS pd
           FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_orderkey,
  CASE WHEN epoch(pk) < epoch(o_orderdate) - 3661 AND pv >= 0 THEN pv END AS prev_v_clean,
  round((epoch(o_orderdate) - epoch(pd)) / 60.0, {R6}) AS gap_sched_min,
  round(CASE WHEN epoch(pk) < epoch(o_orderdate) - 3661 THEN (epoch(o_orderdate) - epoch(pk)) / 60.0 END, {R6}) AS gap_known_min,
  round((epoch(o_orderdate) - epoch(pk)) / 3600.0, {R6}) AS gap_known_h
FROM l"""


@register("w3_safe_lag", _SAFE_SQL)
def q_w3(spark, d):
    r = _safe_lag_df(spark, d, bucket_s=180 * 86400)
    return r.select("o_orderkey", "prev_v_clean", *[F.round(c, R6).alias(c) for c in ("gap_sched_min", "gap_known_min", "gap_known_h")])


@register("w4_gap_since_prev", f"""
SELECT event_id, round((floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))) / 60.0, {R6}) AS gap_min
FROM events""")
def q_w4(spark, d):
    ev = Tables(spark, d).events.select("event_id", "user_id", "ts")
    r = S.gap_since_prev(ev, "user_id", ["ts", "event_id"], "ts", 60.0, out="gap_min", bucket_s=86400)
    return r.select("event_id", F.round("gap_min", R6).alias("gap_min"))


@register("w5_ratio_split", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn, count(*) OVER () AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, flag_len, CASE WHEN rn <= floor(n * 0.6) THEN 'train'
                        WHEN rn <= floor(n * 0.6) + floor(n * 0.2) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, length(l_returnflag) AS flag_len FROM r)""")
def q_w5(spark, d):
    li = Tables(spark, d).lineitem
    out = S.ratio_split(li, "l_shipdate", [0.6, 0.2], tiebreak=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", F.length("l_returnflag").cast("long").alias("flag_len"), "split")
