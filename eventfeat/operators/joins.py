"""Dimension joins (J1, J1x, J2, J4, J5, J9, J10, J11).

No join carries a broadcast hint: the planner and AQE choose by size in bytes, and split
skewed partitions of a sort-merge join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ------------------------------------------------------------------ J1 / J1x

def _calendar_days(cal: DataFrame, date_col: str, days: int, keep: Sequence[str] = ()) -> DataFrame:
    d = F.col(date_col).cast("date")
    return cal.select(*keep, F.explode(F.sequence(F.date_sub(d, days), F.date_add(d, days))).alias("_near_day"))


def near_date_flag(df: DataFrame, cal: DataFrame, df_date: str, cal_date: str = "holiday_date",
                   days: int = 2, out: str = "IS_US_HOLIDAY") -> DataFrame:
    """1 if any calendar date lies within +-``days`` of ``df_date`` else 0.

    The calendar is expanded to the set of covered days (distinct), so the join is
    an equi-join on a date and can never duplicate fact rows."""
    near = _calendar_days(cal, cal_date, days).distinct().withColumn("_hit", F.lit(1))
    j = df.join(near, F.col(df_date).cast("date") == F.col("_near_day"), "left")
    return j.withColumn(out, F.coalesce(F.col("_hit"), F.lit(0))).drop("_near_day", "_hit")


def near_date_join(df: DataFrame, cal: DataFrame, df_date: str, cal_date: str = "holiday_date",
                   cal_cols: Sequence[str] = ("holiday_name",), days: int = 2,
                   out: str = "IS_US_HOLIDAY") -> DataFrame:
    """J1x: left join to *every* calendar row within +-``days`` (a date near two
    entries yields two rows), plus the 0/1 flag -- the source's fan-out semantics,
    done as an equi-join on expanded days instead of a nested-loop range join."""
    near = _calendar_days(cal, cal_date, days, keep=[cal_date, *cal_cols])
    j = df.join(near, F.col(df_date).cast("date") == F.col("_near_day"), "left")
    return j.withColumn(out, F.when(F.col(cal_date).isNotNull(), 1).otherwise(0)).drop("_near_day")


# ------------------------------------------------------------------ J2 / J4 / J9

def inner_enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join followed by a null-rejecting filter is an inner join."""
    return df.join(dim, on=on, how="inner")


def enrich_roles(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
                 cols: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    """Join the same dimension once per role.

    ``roles`` maps an output prefix to the fact column holding that role's key, e.g.
    ``{"cust_": "c_nationkey", "supp_": "s_nationkey"}``; dimension columns come out
    as ``prefix + col + suffix``."""
    cols = [c for c in (cols or dim.columns) if c != dim_key]
    small = dim.select(dim_key, *cols)
    out = df
    for prefix, fk in roles.items():
        d = small.select(F.col(dim_key).alias(f"_{prefix}key"),
                         *[F.col(c).alias(f"{prefix}{c}{suffix}") for c in cols])
        out = out.join(d, out[fk] == d[f"_{prefix}key"], "left").drop(f"_{prefix}key")
    return out


# ------------------------------------------------------------------ J5

def enrich_with_fallback(df: DataFrame, primary: DataFrame, backup: DataFrame, fact_key: str, dim_key: str,
                         cols: Sequence[str], prefix: str = "") -> DataFrame:
    """Enrich from ``primary``; any column it leaves NULL (no row, or NULL value)
    is filled from ``backup``.  The two dimensions are merged first (full outer join
    on the key, per-column ``coalesce``) so the fact table is joined once."""
    p = primary.select(F.col(dim_key).alias("_k"), *[F.col(c).alias(f"_p_{c}") for c in cols])
    b = backup.select(F.col(dim_key).alias("_kb"), *[F.col(c).alias(f"_b_{c}") for c in cols])
    merged = p.join(b, p["_k"] == b["_kb"], "full_outer").select(
        F.coalesce("_k", "_kb").alias("_key"),
        *[F.coalesce(F.col(f"_p_{c}"), F.col(f"_b_{c}")).alias(f"{prefix}{c}") for c in cols])
    return df.join(merged, df[fact_key] == merged["_key"], "left").drop("_key")


# ------------------------------------------------------------------ J10

@dataclass
class TargetEncoding:
    """Fitted mean-target encoding: per-key means (a DataFrame) + global mean."""
    key: str
    table: DataFrame
    global_mean: float
    out: str

    def apply(self, df: DataFrame) -> DataFrame:
        # the encoding table is an aggregate of the training rows: no eager size
        # check (it would cost a pass); AQE broadcasts it at runtime when small
        return (df.join(self.table, on=self.key, how="left")
                .withColumn(self.out, F.coalesce(F.col(self.out), F.lit(self.global_mean))))


def fit_target_encoding(train: DataFrame, key: str, y: str, out: str | None = None) -> TargetEncoding:
    """Mean of ``y`` per ``key`` on the training rows only; unseen keys get the
    training global mean."""
    out = out or f"{key}_te"
    table = train.groupBy(key).agg(F.avg(F.col(y).cast("double")).alias(out))
    g = train.agg(F.avg(F.col(y).cast("double"))).first()[0]
    return TargetEncoding(key, table, float(g) if g is not None else None, out)


# ------------------------------------------------------------------ J11

EARTH_RADIUS_KM = 6371.0088
KM_PER_DEG_LAT = math.pi * EARTH_RADIUS_KM / 180.0


def haversine_km(lat1, lon1, lat2, lon2):
    r = F.lit(math.pi / 180.0)
    dlat = (lat2 - lat1) * r
    dlon = (lon2 - lon1) * r
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(lat1 * r) * F.cos(lat2 * r) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def zone_lookup(points: DataFrame, zones: DataFrame, point_key: str | Sequence[str], lat: str, lon: str,
                zone_id: str = "zone_id", zone_lat: str = "zone_lat", zone_lon: str = "zone_lon",
                zone_cols: Sequence[str] = ("zone",), max_km: float = 1500.0, cell_deg: float = 10.0,
                distance_col: str = "zone_km") -> DataFrame:
    """Attach the nearest reference point (and its zone) within ``max_km``.

    Grid-cell equi-join: each reference point is copied into every cell its
    ``max_km`` disc can touch (more longitude cells towards the poles), points join
    on their own cell, and ``min_by`` keeps the nearest (ties: smallest id).  Exact
    for the radius; no point x zone product beyond the neighbouring cells.  One
    output row per input row, whatever ``point_key`` holds (kept for callers)."""
    lat_span = max_km / KM_PER_DEG_LAT
    n_lat = int(math.ceil(lat_span / cell_deg))
    n_lon_cells = int(math.ceil(360.0 / cell_deg))
    zc = zones.select(F.col(zone_id).alias("_zid"), F.col(zone_lat).cast("double").alias("_zlat"),
                      F.col(zone_lon).cast("double").alias("_zlon"), *zone_cols)
    # longitude reach per zone: widest at the disc edge nearest the pole
    edge = F.least(F.lit(89.999), F.abs(F.col("_zlat")) + F.lit(lat_span))
    lon_span = F.lit(lat_span) / F.cos(F.radians(edge))
    n_lon = F.least(F.lit(n_lon_cells // 2 + 1), F.ceil(lon_span / F.lit(cell_deg)).cast("int"))
    zc = (zc.withColumn("_clat0", F.floor(F.col("_zlat") / cell_deg).cast("int"))
          .withColumn("_clon0", F.floor(F.col("_zlon") / cell_deg).cast("int"))
          .withColumn("_dlat", F.explode(F.sequence(F.lit(-n_lat), F.lit(n_lat))))
          .withColumn("_dlon", F.explode(F.sequence(-n_lon, n_lon)))
          .select("*", (F.col("_clat0") + F.col("_dlat")).alias("_clat"),
                  F.pmod(F.col("_clon0") + F.col("_dlon"), F.lit(n_lon_cells)).alias("_clon"))
          .drop("_clat0", "_clon0", "_dlat", "_dlon")
          .dropDuplicates(["_zid", "_clat", "_clon"]))
    pts = points.withColumn("_plat", F.col(lat).cast("double")).withColumn("_plon", F.col(lon).cast("double"))
    pts = (pts.withColumn("_clat", F.floor(F.col("_plat") / cell_deg).cast("int"))
           .withColumn("_clon", F.pmod(F.floor(F.col("_plon") / cell_deg).cast("int"), F.lit(n_lon_cells))))
    # nearest zone of each distinct place, then joined back: rows that share a key or a
    # place, and rows without a place, all keep their own row
    places = pts.select("_plat", "_plon", "_clat", "_clon").distinct()
    j = places.join(zc, on=["_clat", "_clon"], how="inner")
    d = haversine_km(F.col("_plat"), F.col("_plon"), F.col("_zlat"), F.col("_zlon"))
    j = j.withColumn("_d", d).filter(F.col("_d") <= max_km)
    best = F.min_by(F.struct(F.col("_zid").alias(zone_id), *[F.col(c) for c in zone_cols], F.col("_d").alias(distance_col)),
                    F.struct(F.col("_d"), F.col("_zid")))
    g = j.groupBy("_plat", "_plon").agg(best.alias("_best"))
    out = pts.join(g, on=["_plat", "_plon"], how="left")
    return out.select(*points.columns, *[F.col("_best")[c].alias(c) for c in [zone_id, *zone_cols, distance_col]])
