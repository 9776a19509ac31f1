"""Queries for the row-level parsers and clock algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventfeat.functions import codes as CD
from eventfeat.functions import numeric as N
from eventfeat.functions import timecols as TC
from eventfeat.plans.fixtures import fixture, with_fixtures
from eventfeat.plans.registry import register

R6 = 6

# ---------------------------------------------------------------- X1

_WX_TOK = ("regexp_split_to_array(trim(regexp_replace(regexp_replace(translate(regexp_replace(upper(coalesce(wx, '')), "
           f"'{CD.DROP_PATTERN}', '', 'g'), '|', ' '), '{CD.KEEP_CHARS_PATTERN}', ' ', 'g'), '\\s+', ' ', 'g')), '\\s+')")


def _x1_sql() -> str:
    flags = []
    for name, pats in CD.WEATHER_RULES.items():
        cond = " OR ".join(f"len(list_filter(tok, lambda x: regexp_matches(x, '{p}'))) > 0" for p in pats)
        flags.append(f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {name}")
    label = "concat_ws(' ', " + ", ".join(
        f"CASE WHEN {n} = 1 THEN '{CD.WEATHER_LABELS[n]}' END" for n in CD.WEATHER_RULES) + ") AS ReadableWeather"
    names = ", ".join(CD.WEATHER_RULES)
    return with_fixtures(f"""
WITH t AS (SELECT event_id, {_WX_TOK} AS tok FROM ev_codes),
     f AS (SELECT event_id, {", ".join(flags)} FROM t)
SELECT event_id, {names}, {label} FROM f""", "ev_codes")


@register("x1_parse_codes", _x1_sql())
def q_x1(spark, d):
    return CD.parse_codes(fixture(spark, d, "ev_codes").select("event_id", "wx"), "wx").drop("wx")


# ---------------------------------------------------------------- X2 / X2b

_SKY_TOK = ("regexp_split_to_array(trim(regexp_replace(translate(regexp_replace(upper(coalesce(sky, '')), "
            f"'{CD.DROP_PATTERN}', '', 'g'), '|', ' '), '\\s+', ' ', 'g')), '\\s+')")

_X2_SQL = with_fixtures(f"""
WITH t AS (SELECT event_id, {_SKY_TOK} AS tok FROM ev_codes),
     u AS (SELECT event_id, list_filter(tok, lambda x: regexp_matches(x, '{CD.COVER_PATTERN}')) AS cov,
                  list_filter(tok, lambda x: regexp_matches(x, '{CD.BASE_PATTERN}')) AS base FROM t),
     v AS (SELECT event_id, list_transform(cov, lambda x: regexp_extract(x, '{CD.COVER_CODE_PATTERN}', 1)) AS codes,
                  list_transform(cov, lambda x: CAST(regexp_extract(x, '{CD.COVER_OKTA_PATTERN}', 1) AS INTEGER)) AS oktas,
                  list_transform(base, lambda x: CAST(x AS INTEGER) * 100) AS bases FROM u),
     w AS (SELECT *, greatest(len(codes), len(bases)) AS n FROM v)
SELECT event_id,
  CASE WHEN list_contains(codes, 'FEW') THEN 1 WHEN len(bases) > len(codes) THEN NULL ELSE 0 END AS has_few,
  CASE WHEN list_contains(codes, 'SCT') THEN 1 WHEN len(bases) > len(codes) THEN NULL ELSE 0 END AS has_sct,
  CASE WHEN list_contains(codes, 'BKN') THEN 1 WHEN len(bases) > len(codes) THEN NULL ELSE 0 END AS has_bkn,
  CASE WHEN list_contains(codes, 'OVC') THEN 1 WHEN len(bases) > len(codes) THEN NULL ELSE 0 END AS has_ovc,
  CAST(CASE WHEN n > 0 THEN list_max(oktas) ELSE 0 END AS DOUBLE) / 8.0 AS overall_cloud_frac_0_1,
  CASE WHEN n > 0 THEN list_min(bases) END AS lowest_cloud_ft,
  CASE WHEN n > 0 THEN list_max(bases) END AS highest_cloud_ft,
  round(CASE WHEN n > 0 THEN CASE WHEN len(bases) < n THEN NULL ELSE list_sum(bases) / n END END, {R6}) AS mean_cloud_ft,
  CASE WHEN n > 0 THEN list_max(bases) END - CASE WHEN n > 0 THEN list_min(bases) END AS cloud_base_range_ft,
  coalesce(list_min(list_transform(list_filter(range(1, len(codes) + 1), lambda i: codes[i] IN ('BKN', 'OVC')), lambda i: bases[i])), 0) AS ceiling_ft,
  CASE WHEN n = 0 THEN 1 ELSE 0 END AS sky_missing,
  CASE WHEN len(codes) <> len(bases) THEN 1 ELSE 0 END AS misaligned
FROM w""", "ev_codes")


@register("x2_parse_layers", _X2_SQL)
def q_x2(spark, d):
    r = CD.parse_layers(fixture(spark, d, "ev_codes").select("event_id", "sky"), "sky", extra=True, keep_layers=False)
    return r.drop("sky").withColumn("mean_cloud_ft", F.round("mean_cloud_ft", R6))


@register("x2c_coalesce_first", with_fixtures(
    "SELECT event_id, coalesce(alt, sea, stn, sea) AS pressure FROM ev_clock", "ev_clock"))
def q_x2c(spark, d):
    return CD.coalesce_first(fixture(spark, d, "ev_clock"), ["alt", "sea", "stn", "sea"], "pressure").select("event_id", "pressure")


# ---------------------------------------------------------------- X3-X8, X10

@register("x3_normalize_2400", with_fixtures("""
SELECT event_id, CASE WHEN dep_time = 2400 THEN 0 ELSE dep_time END AS dep_clean,
  CASE WHEN arr_time = 2400 THEN 0 ELSE arr_time END AS arr_clean,
  CASE WHEN crs_dep = 2400 THEN 0 ELSE crs_dep END AS crs_dep_clean,
  CASE WHEN crs_arr = 2400 THEN 0 ELSE crs_arr END AS crs_arr_clean FROM ev_clock""", "ev_clock"))
def q_x3(spark, d):
    f = fixture(spark, d, "ev_clock")
    return f.select("event_id", *[TC.normalize_2400(c).alias(o) for c, o in
                                  (("dep_time", "dep_clean"), ("arr_time", "arr_clean"), ("crs_dep", "crs_dep_clean"),
                                   ("crs_arr", "crs_arr_clean"))])


def _dates_sql(compat: bool) -> str:
    arr_else = "fl_date" if compat else "DEP_DATE"
    return f"""
d AS (SELECT *, CASE WHEN (dep_time < crs_dep AND dep_delay > 0) OR dep_time = 2400 THEN fl_date + 1 ELSE fl_date END AS DEP_DATE,
             CASE WHEN crs_arr < crs_dep OR crs_arr = 2400 THEN fl_date + 1 ELSE fl_date END AS CRS_ARR_DATE FROM ev_clock),
e AS (SELECT *, CASE WHEN arr_time < dep_time OR arr_time = 2400 THEN DEP_DATE + 1 ELSE {arr_else} END AS ARR_DATE FROM d)"""


def _dates(spark, d, compat=False):
    f = fixture(spark, d, "ev_clock")
    cols = TC.infer_event_dates("fl_date", "dep_time", "crs_dep", "dep_delay", "arr_time", "crs_arr", compat=compat)
    return f.withColumns(cols)


@register("x4_infer_event_dates", with_fixtures(f"WITH {_dates_sql(False)} SELECT event_id, DEP_DATE, ARR_DATE, CRS_ARR_DATE FROM e", "ev_clock"))
def q_x4(spark, d):
    return _dates(spark, d).select("event_id", "DEP_DATE", "ARR_DATE", "CRS_ARR_DATE")


@register("x4_infer_event_dates_compat", with_fixtures(f"WITH {_dates_sql(True)} SELECT event_id, DEP_DATE, ARR_DATE, CRS_ARR_DATE FROM e", "ev_clock"))
def q_x4c(spark, d):
    return _dates(spark, d, compat=True).select("event_id", "DEP_DATE", "ARR_DATE", "CRS_ARR_DATE")


def _ts_sql(date: str, hhmm: str) -> str:
    v = f"(CASE WHEN {hhmm} = 2400 THEN 0 ELSE {hhmm} END)"
    return f"(CAST({date} AS TIMESTAMP) + to_hours(CAST(floor({v} / 100) AS BIGINT)) + to_minutes(CAST({v} % 100 AS BIGINT)))"


_LOCAL_SQL = (f"{_ts_sql('DEP_DATE', 'dep_time')} AS DEP_LOCAL, {_ts_sql('ARR_DATE', 'arr_time')} AS ARR_LOCAL, "
              f"{_ts_sql('fl_date', 'crs_dep')} AS CRS_DEP_LOCAL, {_ts_sql('CRS_ARR_DATE', 'crs_arr')} AS CRS_ARR_LOCAL")


def _locals(spark, d):
    f = _dates(spark, d)
    return f.withColumns({
        "DEP_LOCAL": TC.compose_timestamp("DEP_DATE", "dep_time"),
        "ARR_LOCAL": TC.compose_timestamp("ARR_DATE", "arr_time"),
        "CRS_DEP_LOCAL": TC.compose_timestamp("fl_date", "crs_dep"),
        "CRS_ARR_LOCAL": TC.compose_timestamp("CRS_ARR_DATE", "crs_arr"),
    })


@register("x5_compose_timestamp", with_fixtures(
    f"WITH {_dates_sql(False)} SELECT event_id, {_LOCAL_SQL} FROM e", "ev_clock"))
def q_x5(spark, d):
    return _locals(spark, d).select("event_id", "DEP_LOCAL", "ARR_LOCAL", "CRS_DEP_LOCAL", "CRS_ARR_LOCAL")


@register("x6_to_utc", with_fixtures(f"""
WITH {_dates_sql(False)}, g AS (SELECT event_id, zone, {_LOCAL_SQL} FROM e)
SELECT event_id, zone, timezone('UTC', CRS_DEP_LOCAL AT TIME ZONE zone) AS CRS_DEP_UTC,
       timezone('UTC', ARR_LOCAL AT TIME ZONE zone) AS ARR_UTC FROM g""", "ev_clock"))
def q_x6(spark, d):
    f = _locals(spark, d)
    return f.select("event_id", "zone", TC.to_utc("CRS_DEP_LOCAL", "zone").alias("CRS_DEP_UTC"),
                    TC.to_utc("ARR_LOCAL", "zone").alias("ARR_UTC"))


@register("x7_hour_of", with_fixtures("""
SELECT event_id, CAST(substr(lpad(CAST(crs_dep AS STRING), 4, '0'), 1, 2) AS INTEGER) AS crs_dep_hour,
       CAST(substr(lpad(CAST(arr_time AS STRING), 4, '0'), 1, 2) AS INTEGER) AS arr_hour FROM ev_clock""", "ev_clock"))
def q_x7(spark, d):
    f = fixture(spark, d, "ev_clock")
    return f.select("event_id", TC.hour_of("crs_dep").alias("crs_dep_hour"), TC.hour_of("arr_time").alias("arr_hour"))


@register("x8_split_pair", with_fixtures("""
SELECT event_id, TRY_CAST(trim(split_part(coords, ',', 1)) AS DOUBLE) AS lat,
       TRY_CAST(trim(split_part(coords, ',', 2)) AS DOUBLE) AS lon FROM ev_clock""", "ev_clock"))
def q_x8(spark, d):
    f = fixture(spark, d, "ev_clock")
    lat, lon = TC.split_pair("coords")
    return f.select("event_id", lat.alias("lat"), lon.alias("lon"))


@register("x10_epoch_interval", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, ts - INTERVAL 3661 SECOND AS lead_ts FROM events""")
def q_x10(spark, d):
    from eventfeat.plans.tables import table
    ev = table(spark, d, "events")
    return ev.select("event_id", TC.epoch_seconds("ts").alias("epoch_s"), TC.minus_seconds("ts", 3661).alias("lead_ts"))


# ---------------------------------------------------------------- X12 / X13

@register("x12_flags_to_double", with_fixtures(
    "SELECT event_id, coalesce(CAST(flag AS DOUBLE), 0.0) AS flag FROM ev_clock", "ev_clock"))
def q_x12(spark, d):
    from eventfeat.operators.profile import flags_to_double
    return flags_to_double(fixture(spark, d, "ev_clock").select("event_id", "flag"), ["flag"])


@register("x13_impute_label", with_fixtures("""
SELECT event_id, CASE WHEN label IS NULL AND actual_min - sched_min >= 15 THEN 1 WHEN label IS NULL THEN 0 ELSE label END AS label
FROM ev_clock""", "ev_clock"))
def q_x13(spark, d):
    f = fixture(spark, d, "ev_clock")
    return f.select("event_id", N.impute_label("label", "actual_min", "sched_min", 15).alias("label"))
