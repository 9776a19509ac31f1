"""The flight-delay pipeline on its own schema, composed from the generic operators.

Stages (each a lazy DataFrame plan; write with ``sources.io`` between stages):

* ``clean_flights``   -- date window, full-row dedup, cancelled/diverted/non-US
  removal, keep-list, FLIGHT_ID, holiday flag (F1-F3, F7, F8, J1).
* ``clean_weather``   -- date window, US stations, sky-layer and present-weather
  parsing, pressure fallback (F2, F4, X1, X2, X2c).
* ``airport_stations``-- airports x station neighbours restricted to flight origins
  by a semi join, nearest station per airport, coordinate split (F5, F6, J2, J3/W1, X8).
* ``enrich_and_localize`` -- origin/destination roles with fallback, roll-over
  dates, local and UTC times, hour columns (J4, J5, J11, X3-X7).
* ``final_join``      -- weather pruned to used stations, backward as-of join with
  lead time and tolerance, match rate (J6, J7, J8).
* ``preprocess``      -- route graph features, leakage-safe tail-number lags with
  audit, wind compass, hour blocks, casts, null policy, label repair (A1-A3, J9,
  W2-W4, A6, F11-F13, X11, X13).
* ``train_test`` / ``rolling_folds`` / ``process_fold`` -- horizon split, rolling
  folds, per-fold skew logs + feature vectors + downsampling (V1-V3, V6, X9, X12, E5).

Where the source pipeline had a defect the default here is the fixed behaviour and
``compat=True`` reproduces the original (see README).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.functions import codes as CD
from eventfeat.functions import numeric as N
from eventfeat.functions import timecols as TC
from eventfeat.operators import clean as C
from eventfeat.operators import graph as G
from eventfeat.operators import joins as J
from eventfeat.operators import profile as P
from eventfeat.operators import sequence as S
from eventfeat.operators import split as V
from eventfeat.operators import zones as Z
from eventfeat.operators.asof import asof_join, match_rate
from eventfeat.operators.features import FeatureSpec, feature_pipeline
from eventfeat.operators.folds import process_folds
from eventfeat.plans import presets as PR

# --- fixed values: column lists of the flight pipeline
FLIGHT_KEEP = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "FL_DATE", "OP_UNIQUE_CARRIER", "TAIL_NUM", "OP_CARRIER_FL_NUM",
    "ORIGIN_CITY_MARKET_ID", "ORIGIN", "ORIGIN_CITY_NAME", "ORIGIN_STATE_ABR", "ORIGIN_STATE_FIPS", "ORIGIN_STATE_NM", "ORIGIN_WAC",
    "DEST_CITY_MARKET_ID", "DEST", "DEST_CITY_NAME", "DEST_STATE_ABR", "DEST_STATE_FIPS", "DEST_STATE_NM", "DEST_WAC",
    "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY", "DEP_DEL15", "DEP_TIME_BLK", "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN",
    "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY", "ARR_DEL15", "ARR_TIME_BLK", "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME",
    "ACTUAL_ELAPSED_TIME", "AIR_TIME", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "ACTUAL_ELAPSED_TIME", "DISTANCE", "DISTANCE_GROUP",
]
WEATHER_KEEP = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "REPORT_TYPE", "SOURCE", "HourlyAltimeterSetting",
    "HourlyDewPointTemperature", "HourlyDryBulbTemperature", "HourlyPrecipitation", "HourlyPresentWeatherType",
    "HourlyPressureChange", "HourlyPressureTendency", "HourlyRelativeHumidity", "HourlySkyConditions",
    "HourlySeaLevelPressure", "HourlyStationPressure", "HourlyVisibility", "HourlyWetBulbTemperature",
    "HourlyWindDirection", "HourlyWindGustSpeed", "HourlyWindSpeed", "REM", "WindEquipmentChangeDate",
]
WEATHER_OUT = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "REPORT_TYPE", "SOURCE",
    "overall_cloud_frac_0_1", "lowest_cloud_ft", "highest_cloud_ft", "has_few", "has_sct", "has_bkn",
    "has_ovc", "HourlyAltimeterSetting", "HourlyWindDirection", "HourlyWindGustSpeed", "HourlyWindSpeed", "light", "heavy",
    "thunderstorm", "rain_or_drizzle", "freezing_conditions", "snow", "hail_or_ice", "reduced_visibility", "spatial_effects",
    "unknown_precip",
]
PRESSURE_ORDER = ["HourlyAltimeterSetting", "HourlySeaLevelPressure", "HourlyStationPressure", "HourlySeaLevelPressure"]
FINAL_FLIGHT_COLS = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "FL_DATE", "IS_US_HOLIDAY", "OP_UNIQUE_CARRIER", "TAIL_NUM",
    "OP_CARRIER_FL_NUM", "ORIGIN_CITY_MARKET_ID", "ORIGIN", "ORIGIN_CITY_NAME", "ORIGIN_STATE_ABR", "ORIGIN_STATE_FIPS",
    "ORIGIN_STATE_NM", "ORIGIN_WAC", "DEST_CITY_MARKET_ID", "DEST", "DEST_CITY_NAME", "DEST_STATE_ABR", "DEST_STATE_FIPS",
    "DEST_STATE_NM", "DEST_WAC", "CRS_DEP_TIME", "CRS_DEP_HOUR", "DEP_TIME", "DEP_HOUR", "DEP_DELAY", "DEP_DEL15",
    "DEP_TIME_BLK", "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "CRS_ARR_TIME", "CRS_ARR_HOUR", "ARR_TIME", "ARR_HOUR",
    "ARR_DELAY", "ARR_DEL15", "ARR_TIME_BLK", "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME", "AIR_TIME",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY", "DISTANCE", "DISTANCE_GROUP",
    "FLIGHT_ID", "ORIGIN_ICAO", "ORIGIN_IATA", "ORIGIN_LAT", "ORIGIN_LONG", "ORIGIN_ELEVATION_FT", "ORIGIN_SIZE", "STATION",
    "DEST_ICAO", "DEST_IATA", "DEST_LAT", "DEST_LON", "DEST_ELEVATION_FT", "DEST_SIZE", "DEP_DATETIME_UTC", "ARR_DATETIME_UTC",
    "CRS_DEP_DATETIME_UTC", "CRS_ARR_DATETIME_UTC",
]
MODEL_COLS = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "IS_US_HOLIDAY", "OP_UNIQUE_CARRIER", "TAIL_NUM", "ORIGIN",
    "ORIGIN_STATE_ABR", "DEST", "DEST_STATE_ABR", "CRS_DEP_TIME_BLOCK", "CRS_DEP_DATETIME_UTC", "CRS_ARR_TIME_BLOCK",
    "ARR_DEL15", "CRS_ELAPSED_TIME", "CARRIER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY", "DISTANCE",
    "ORIGIN_LAT", "ORIGIN_LONG", "ORIGIN_ELEVATION_FT", "ORIGIN_SIZE", "DEST_LAT", "DEST_LON", "DEST_ELEVATION_FT",
    "DEST_SIZE", "overall_cloud_frac_0_1", "lowest_cloud_ft", "highest_cloud_ft", "has_few", "has_sct", "has_bkn", "has_ovc",
    "HourlyAltimeterSetting", "HourlyWindCardinalDirection", "HourlyWindGustSpeed", "HourlyWindSpeed", "light", "heavy",
    "thunderstorm", "rain_or_drizzle", "freezing_conditions", "snow", "hail_or_ice", "reduced_visibility",
    "spatial_effects", "unknown_precip", "origin_pagerank", "dest_pagerank", "origin_out_degree", "dest_in_degree",
    "prev_flight_arr_delay_clean", "actual_to_crs_time_to_next_flight_diff_mins_clean", "crs_time_to_next_flight_diff_mins",
]
TO_DOUBLE = ["ORIGIN_LAT", "ORIGIN_LONG", "HourlyAltimeterSetting", "DEST_LAT", "DEST_LON"]
TO_INT = ["ARR_DEL15", "CARRIER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY", "HourlyWindGustSpeed",
          "HourlyWindSpeed", "HourlyWindDirection"]
DATE_WINDOW = ("2015-01-01", "2020-01-01")
HORIZON_SPLITS = {"3m": ("2015-01-01", 2, 1), "6m": ("2015-01-01", 5, 1), "1y": ("2019-01-01", 9, 3),
                  "5y": ("2015-01-01", 48, 12)}
OUTPUT_FILES, OUTPUT_KEYS = 100, ["FL_DATE", "OP_UNIQUE_CARRIER"]


def calendar(spark, first_year: int = 2015, last_year: int = 2019) -> DataFrame:
    from eventfeat.sources.io import literal_table
    rows = PR.us_holidays(first_year, last_year) + [(f"{last_year + 1}-01-01", "New Year's Day")]
    return literal_table(spark, rows, "holiday_date string, holiday_name string").select(
        F.to_date("holiday_date").alias("holiday_date"), "holiday_name")


def clean_flights(flights: DataFrame, cal: DataFrame, window=DATE_WINDOW, compat: bool = False) -> DataFrame:
    """Date window, full-row dedup, cancelled/diverted and non-US airport removal,
    keep-list, FLIGHT_ID and the +-2-day holiday flag."""
    # the bounds take the column's type, so the filter reaches the scan
    kind = flights.schema["FL_DATE"].dataType
    if kind.typeName() == "string":
        inside = F.col("FL_DATE").between(*window)
    else:
        inside = (F.col("FL_DATE") >= F.lit(window[0]).cast("date").cast(kind)) & (
            F.col("FL_DATE") < F.date_add(F.lit(window[1]).cast("date"), 1).cast(kind))
    df = flights.filter(inside)
    df = C.dedup(df)
    df = C.exclude(df, equals={"CANCELLED": 0, "DIVERTED": 0},
                   not_in={"ORIGIN": PR.AIRPORTS_TO_REMOVE, "DEST": PR.AIRPORTS_TO_REMOVE})
    df = C.keep(df, FLIGHT_KEEP)
    fid = C.compose_key([F.col("FL_DATE").cast("string"), TC.hhmm_int("CRS_DEP_TIME"), "TAIL_NUM", "OP_CARRIER_FL_NUM",
                         "ORIGIN", "DEST"], pads={1: 4}, null_token=None if compat else "")
    df = df.withColumn("FLIGHT_ID", fid).withColumn("FL_DATE", F.to_date("FL_DATE"))
    if compat:
        return J.near_date_join(df, cal, "FL_DATE").drop("holiday_date", "holiday_name")
    return J.near_date_flag(df, cal, "FL_DATE")


def clean_weather(weather: DataFrame, window=DATE_WINDOW) -> DataFrame:
    df = weather.filter(F.col("DATE").between(F.lit(window[0]), F.lit(window[1])))
    df = C.contains(df, "NAME", "US").select(*WEATHER_KEEP)
    df = CD.parse_layers(df, "HourlySkyConditions", keep_layers=False)
    df = CD.coalesce_first(df, PRESSURE_ORDER, "HourlyAltimeterSetting")
    df = CD.parse_codes(df, "HourlyPresentWeatherType")
    return df.select(*WEATHER_OUT)


def airport_stations(stations: DataFrame, airports: DataFrame, flights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(airports with their nearest weather station, backup airport table)."""
    ap = C.require(airports.filter(F.col("iso_country") == "US"), ["icao_code", "iata_code"])
    origins = flights.select(F.col("ORIGIN").alias("iata_code")).distinct()
    linked = stations.join(ap, stations["neighbor_call"] == ap["icao_code"], "inner")
    linked = C.restrict_to(linked, origins, "iata_code")
    nearest = S.top1(linked, "icao_code", ["distance_to_neighbor", "station_id"], descending=False)

    def _clean(d: DataFrame, with_station: bool) -> DataFrame:
        d = C.require(d, ["icao_code", "iata_code"], {"iata_code": 3})
        lat, lon = TC.split_pair("coordinates")
        d = d.withColumn("latitude", lat).withColumn("longitude", lon).filter(
            F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        cols = ["icao_code", "iata_code", "latitude", "longitude", "elevation_ft", "type"]
        return d.select(*cols, *(["station_id"] if with_station else []))

    return _clean(nearest, True), _clean(ap, False)


_ROLE_NAMES = {
    "ORIGIN": {"iata_code": "ORIGIN_IATA", "latitude": "ORIGIN_LAT", "longitude": "ORIGIN_LONG", "icao_code": "ORIGIN_ICAO",
               "elevation_ft": "ORIGIN_ELEVATION_FT", "type": "ORIGIN_SIZE", "station_id": "STATION"},
    "DEST": {"iata_code": "DEST_IATA", "latitude": "DEST_LAT", "longitude": "DEST_LON", "icao_code": "DEST_ICAO",
             "elevation_ft": "DEST_ELEVATION_FT", "type": "DEST_SIZE"},
}


def enrich_and_localize(flights: DataFrame, airports_clean: DataFrame, airports_backup: DataFrame, zones: DataFrame,
                        compat: bool = False) -> DataFrame:
    """Origin/destination attributes (primary table, backup fills gaps), roll-over
    dates, local timestamps, zone of each airport (the zone around it, or nearest reference point, J11),
    UTC timestamps and hour columns."""
    df = flights
    for role, names in _ROLE_NAMES.items():
        cols = [c for c in names if c not in ("iata_code", "station_id")]
        prim = airports_clean.select("iata_code", *cols, *(["station_id"] if "station_id" in names else []))
        back = airports_backup.select("iata_code", *cols)
        if "station_id" in names:
            back = back.withColumn("station_id", F.lit(None).cast("string"))
        merged_cols = cols + (["station_id"] if "station_id" in names else [])
        df = J.enrich_with_fallback(df, prim, back, role, "iata_code", ["iata_code", *merged_cols], prefix="_r_")
        df = df.withColumnsRenamed({f"_r_{c}": names[c] for c in ["iata_code", *merged_cols]})
    dates = TC.infer_event_dates("FL_DATE", "DEP_TIME", "CRS_DEP_TIME", "DEP_DELAY", "ARR_TIME", "CRS_ARR_TIME", compat=compat)
    df = df.withColumns(dates)
    local = {
        "DEP_DATETIME_LOCAL": TC.compose_timestamp("DEP_DATE", "DEP_TIME"),
        "ARR_DATETIME_LOCAL": TC.compose_timestamp("ARR_DATE", "ARR_TIME"),
        "CRS_DEP_DATETIME_LOCAL": TC.compose_timestamp("FL_DATE", "CRS_DEP_TIME"),
        "CRS_ARR_DATETIME_LOCAL": TC.compose_timestamp("CRS_ARR_DATE", "CRS_ARR_TIME"),
    }
    df = df.withColumns(local)
    # zone per airport from the airport table (one row per airport), joined on both roles
    places = airports_backup.select("iata_code", "latitude", "longitude").dropDuplicates(["iata_code"])
    if "ring" in zones.columns:  # borders: zone_id, zone, ring, seq, lat, lon
        zone_of = Z.zone_containing(places, zones, "latitude", "longitude", zone_cols=["zone"])
    else:
        zone_of = J.zone_lookup(places, zones, "iata_code", "latitude", "longitude")
    zone_of = zone_of.select("iata_code", F.col("zone").alias("TIMEZONE"))
    df = J.enrich_roles(df, zone_of, "iata_code", {"ORIGIN_": "ORIGIN", "DEST_": "DEST"})
    df = df.withColumns({
        "DEP_DATETIME_UTC": TC.to_utc("DEP_DATETIME_LOCAL", "ORIGIN_TIMEZONE"),
        "ARR_DATETIME_UTC": TC.to_utc("ARR_DATETIME_LOCAL", "DEST_TIMEZONE"),
        "CRS_DEP_DATETIME_UTC": TC.to_utc("CRS_DEP_DATETIME_LOCAL", "ORIGIN_TIMEZONE"),
        "CRS_ARR_DATETIME_UTC": TC.to_utc("CRS_ARR_DATETIME_LOCAL", "DEST_TIMEZONE"),
        "CRS_ARR_HOUR": TC.hour_of("CRS_ARR_TIME"), "ARR_HOUR": TC.hour_of("ARR_TIME"),
        "CRS_DEP_HOUR": TC.hour_of("CRS_DEP_TIME"), "DEP_HOUR": TC.hour_of("DEP_TIME"),
    })
    return df.select(*FINAL_FLIGHT_COLS)


def final_join(flights: DataFrame, weather: DataFrame, offset_h: float = PR.ASOF_OFFSET_H,
               tolerance_h: float = PR.ASOF_TOLERANCE_H) -> DataFrame:
    """Weather pruned to used stations, then the latest observation at least
    ``offset_h`` and at most ``offset_h + tolerance_h`` before scheduled departure."""
    used = flights.select(F.col("STATION")).distinct()
    wx = C.restrict_to(weather, used, "STATION").withColumn("DATE", F.col("DATE").cast("timestamp_ntz"))
    cols = [c for c in weather.columns if c not in ("STATION", "DATE")]
    wx = wx.withColumn("WX_STATION", F.col("STATION"))
    out = asof_join(flights, wx, "STATION", "CRS_DEP_DATETIME_UTC", "DATE", offset_s=offset_h * 3600,
                    tolerance_s=tolerance_h * 3600, right_cols=["WX_STATION", *cols], tiebreak=None,
                    target_col="TARGET_TIME_UTC", matched_col="MATCHED_OBS_TIME_UTC")
    return out.withColumn("T_EPOCH", TC.epoch_seconds("TARGET_TIME_UTC"))


def weather_match_rate(joined: DataFrame) -> DataFrame:
    return match_rate(joined, "MATCHED_OBS_TIME_UTC")


def preprocess(df: DataFrame, fit_rows: DataFrame | None = None, lead_s: int = PR.LAG_LEAD_S,
               bucket_s: float | None = 30 * 86400) -> DataFrame:
    """Graph + lag features, audits, buckets, casts, null policy, label repair.

    ``fit_rows`` (e.g. the training split) is where the graph and the median are
    fitted; by default all rows, as the source pipeline did."""
    fit_given = fit_rows is not None
    edges = G.edge_weights(fit_rows if fit_given else df, "ORIGIN", "DEST")
    m = G.node_metrics(edges)
    df = J.enrich_roles(df, m.select("node", "pagerank", "out_degree"), "node", {"origin_": "ORIGIN"})
    df = J.enrich_roles(df, m.select("node", "pagerank", "in_degree"), "node", {"dest_": "DEST"})
    lag = S.lag_features(df, "TAIL_NUM", ["CRS_DEP_DATETIME_UTC", "FLIGHT_ID"],
                         ["ARR_DELAY", "ARR_DATETIME_UTC", "CRS_ARR_DATETIME_UTC"], prefix="_prev_", bucket_s=bucket_s)
    now = TC.epoch_seconds("CRS_DEP_DATETIME_UTC")
    prev_arr = TC.epoch_seconds("_prev_ARR_DATETIME_UTC")
    safe = prev_arr < now - F.lit(lead_s)
    df = lag.withColumns({
        "prev_flight_arr_delay_clean": F.when(safe & (F.col("_prev_ARR_DELAY") >= 0), F.col("_prev_ARR_DELAY")),
        "crs_time_to_next_flight_diff_mins": (now - TC.epoch_seconds("_prev_CRS_ARR_DATETIME_UTC")) / 60,
        "actual_to_crs_time_to_next_flight_diff_mins_clean": F.when(safe, (now - prev_arr) / 60),
        "prev_crs_arr_time_utc": F.col("_prev_CRS_ARR_DATETIME_UTC"),
        "leakage": (now - prev_arr) / 3600,
    }).drop("_prev_ARR_DELAY", "_prev_ARR_DATETIME_UTC", "_prev_CRS_ARR_DATETIME_UTC")
    df = C.coerce(df, {c: "double" for c in ["HourlyWindDirection", "HourlyWindGustSpeed", "HourlyWindSpeed"]})
    df = df.withColumn("HourlyWindCardinalDirection", N.compass("HourlyWindDirection"))
    df = df.withColumns({"CRS_DEP_TIME_BLOCK": TC.hour_block("CRS_DEP_TIME"), "CRS_ARR_TIME_BLOCK": TC.hour_block("CRS_ARR_TIME")})
    df = C.coerce(df, {**{c: "int" for c in TO_INT}, **{c: "double" for c in TO_DOUBLE}})
    policy = P.fit_null_policy(preprocess_fit_frame(df, fit_rows) if fit_given else df, zero=PR.ZERO_FILL, median=PR.MEDIAN_FILL,
                               const={"HourlyAltimeterSetting": PR.ALTIMETER_STANDARD})
    df = policy.apply(df)
    df = df.withColumn("ARR_DEL15", N.impute_label("ARR_DEL15", "ACTUAL_ELAPSED_TIME", "CRS_ELAPSED_TIME", 15))
    return df


def preprocess_fit_frame(df: DataFrame, fit_rows: DataFrame) -> DataFrame:
    """Rows the null policy is fitted on: the rows of ``df`` whose FLIGHT_ID is in
    ``fit_rows`` (so the derived columns exist)."""
    return C.restrict_to(df, fit_rows.select("FLIGHT_ID").distinct(), "FLIGHT_ID")


def leakage_check(df: DataFrame, lead_s: int = PR.LAG_LEAD_S) -> DataFrame:
    return P.leakage_audit(df, "leakage", lead_s / 3600.0,
                           ["prev_flight_arr_delay_clean", "actual_to_crs_time_to_next_flight_diff_mins_clean"])


def model_table(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The model's columns; ``keep`` adds keys (the downsampler needs ``FLIGHT_ID``)."""
    return df.select(*keep, *MODEL_COLS)


# Columns and kinds that a later stage relies on; a stage must have them when written.
STAGE_CONTRACT = {
    "final_join": {"FLIGHT_ID": "string", "STATION": "string", "ORIGIN": "string", "DEST": "string", "TAIL_NUM": "string",
                   "CRS_DEP_DATETIME_UTC": "timestamp_ntz", "MATCHED_OBS_TIME_UTC": "timestamp_ntz"},
    "preprocessed": {"FLIGHT_ID": "string", "CRS_DEP_DATETIME_UTC": "timestamp_ntz", "ARR_DEL15": None, **{c: None for c in MODEL_COLS if c != "CRS_DEP_DATETIME_UTC"}},
    "train_test": {"split": "string", "FLIGHT_ID": "string", "CRS_DEP_DATETIME_UTC": "timestamp_ntz"},
    "rolling_windows": {"fold": "int", "role": "string", "FLIGHT_ID": "string"},
    "processed": {"FLIGHT_ID": "string", "ARR_DEL15": None, "log_scaled_features": "vector", "full_unscaled_features": "vector"},
}


def check_stage(df: DataFrame, stage: str) -> DataFrame:
    """``df`` if it keeps the stage's contract; an error that names what differs if not."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    name = lambda t: "vector" if type(t).__name__ == "VectorUDT" else t.simpleString()
    wrong = [f"{c}: {name(kinds[c]) if c in kinds else 'missing'}" + (f", not {want}" if want and c in kinds else "")
             for c, want in STAGE_CONTRACT[stage].items() if c not in kinds or (want and name(kinds[c]) != want)]
    if wrong:
        raise ValueError(f"stage {stage}: " + "; ".join(wrong))
    return df


def train_test(df: DataFrame, horizon: str = "5y", ts: str = "CRS_DEP_DATETIME_UTC") -> DataFrame:
    start, tr, te = HORIZON_SPLITS[horizon]
    return V.horizon_split(df, ts, start, tr, te)


def rolling_folds(train: DataFrame, horizon: str = "5y", ts: str = "CRS_DEP_DATETIME_UTC") -> DataFrame:
    """Train rows tagged with every (fold, role) of the horizon's rolling scheme."""
    tm, vm, sm = V.ROLLING[horizon]
    return V.assign_folds(train, ts, V.rolling_windows(train, ts, tm, vm, sm))


def process_fold(train: DataFrame, val: DataFrame, target: str = "ARR_DEL15", downsample_ratio: float | None = 1.0,
                 seed: int = 42, log_candidates: Sequence[str] = PR.LOG_CANDIDATES):
    """Per fold: signed logs for columns skewed on train, flags to double, feature
    pipeline fitted on train, majority downsampling of train.  Returns
    ``(train_out, val_out, fitted_pipeline, logged_columns)``."""
    sk = P.fit_skew_log(train, [c for c in log_candidates if c in train.columns])
    train, val = sk.apply(train), sk.apply(val)
    train, val = P.flags_to_double(train, PR.BINARY_COLS), P.flags_to_double(val, PR.BINARY_COLS)
    spec = FeatureSpec(numeric=PR.NUM_COLS, categorical=PR.CAT_COLS + PR.CYCLICAL_COLS, binary=PR.BINARY_COLS,
                       log_cols=sk.cols)
    pm = feature_pipeline(spec).fit(train)
    tr, va = pm.transform(train), pm.transform(val)
    if downsample_ratio is not None:
        tr = V.downsample(tr, target, "FLIGHT_ID", target_ratio=downsample_ratio, seed=seed)
    return tr, va, pm, sk.cols


def process_windows(windows: DataFrame, target: str = "ARR_DEL15", downsample_ratio: float | None = 1.0, seed: int = 42,
                    log_candidates: Sequence[str] = PR.LOG_CANDIDATES):
    """``process_fold`` for all folds of the rolling windows in one pass; returns the rows
    of all folds and their fitted statistics."""
    spec = FeatureSpec(numeric=PR.NUM_COLS, categorical=PR.CAT_COLS + PR.CYCLICAL_COLS, binary=PR.BINARY_COLS)
    return process_folds(windows, spec, log_candidates, target=target, key="FLIGHT_ID", downsample_ratio=downsample_ratio, seed=seed)


_STAGE_SUFFIX = {"3m": "3m", "6m": "6m", "1y": "1y", "5y": "all"}


def run_stages(spark, flights_path: str, weather_path: str, stations_path: str, airports_csv: str, zones: DataFrame,
               out_root: str, horizon: str = "5y", fit_on_train: bool = True) -> dict[str, str]:
    """Run every stage, writing parquet between stages (each stage restarts from
    short, reliable lineage and survives executor loss):

    ``final_join`` (100 files by date + carrier) -> ``preprocessed`` ->
    ``train_test/split=*`` -> ``rolling_windows/fold=*/role=*`` ->
    ``processed/fold=*/role=*`` and ``processed_train_test/split=*`` (fitted on train, not
    downsampled).  ``preprocessed`` has the model's columns and ``FLIGHT_ID`` only, after
    the leakage audit has found nothing; every stage keeps its contract.  Each stage but the
    last is committed as a new version of its folder, so a run that fails leaves the former
    run's stages as they were.  Returns the written paths."""
    from eventfeat.sources import io as IO

    sfx = _STAGE_SUFFIX[horizon]
    path = {name: IO.stage_path(out_root, name, sfx) for name in
            ("weather_clean", "final_join", "preprocessed", "train_test", "rolling_windows", "processed", "processed_train_test", "metrics")}
    fl = clean_flights(spark.read.parquet(flights_path), calendar(spark))
    ap, backup = airport_stations(spark.read.parquet(stations_path), IO.read_csv(spark, airports_csv), fl)
    full = enrich_and_localize(fl, ap, backup, zones)

    def commit(df, name, **how):
        path[name] = IO.write_version(check_stage(df, name) if name in STAGE_CONTRACT else df, path[name], **how)

    commit(clean_weather(spark.read.parquet(weather_path)), "weather_clean")
    wx = spark.read.parquet(path["weather_clean"])
    commit(final_join(full, wx), "final_join", n=OUTPUT_FILES, keys=OUTPUT_KEYS)
    joined = spark.read.parquet(path["final_join"])
    fit_rows = train_test(joined, horizon).filter(F.col("split") == "train") if fit_on_train else None
    # written with its audit column first: the audit and the narrowed stage read it once each
    audited = IO.scratch_path(spark, "audited")
    IO.write_stage(preprocess(joined, fit_rows=fit_rows), audited)
    full = spark.read.parquet(audited)
    audit = leakage_check(full).first().asDict()
    if leaked := {k: v for k, v in audit.items() if k.endswith("_violations") and v}:
        raise ValueError(f"features known too late: {leaked}")
    commit(model_table(full, keep=["FLIGHT_ID"]), "preprocessed")
    pre = spark.read.parquet(path["preprocessed"])
    commit(train_test(pre, horizon), "train_test", partition_by=["split"])
    train = IO.read_partition(spark, path["train_test"], split="train").drop("split")
    ts = "CRS_DEP_DATETIME_UTC"
    folds = V.rolling_windows(train, ts, *V.ROLLING[horizon])
    if not folds.isEmpty():
        commit(V.assign_folds(train, ts, folds), "rolling_windows", partition_by=["fold", "role"])
        windows = spark.read.parquet(path["rolling_windows"])
        done, _ = process_windows(windows)
        commit(done, "processed", partition_by=["fold", "role"])
    if not train.isEmpty():
        test = spark.read.parquet(path["train_test"]).filter(F.col("split") == "test").drop("split")
        tr, te, _, _ = process_fold(train, test, downsample_ratio=None)
        IO.write_stage(check_stage(tr, "processed"), f"{path['processed_train_test']}/split=train")
        IO.write_stage(check_stage(te, "processed"), f"{path['processed_train_test']}/split=test")
    return path


def train_and_test(spark, path: Mapping[str, str], arch: str = "mlp1", target: str = "ARR_DEL15",
                   features: str = "log_scaled_features", thresholds: Sequence[float] = PR.SWEEP_THRESHOLDS,
                   max_iter: int | None = None, run_id: str = "run") -> DataFrame:
    """Train, sweep and blind test on the stages that ``run_stages`` wrote.

    Per fold: fit on its processed train rows, score its validation rows, sweep the
    thresholds.  The threshold with the best mean F2 over the folds (0.5 without folds) is
    then used once on the test split, scored by a model fitted on the whole training
    split.  All metrics go to the metric log; the test metrics are returned."""
    from eventfeat.operators import evaluate as EV
    from eventfeat.operators.train import ARCH, MAX_ITER, score, train_mlp
    from eventfeat.sources import io as IO

    a, steps = ARCH[arch], max_iter or MAX_ITER

    def fitted(train, other):
        model = train_mlp(train, features, target, hidden=a["hidden"], step_size=a["step_size"], max_iter=steps)
        return score(model, other).select(F.col(target).cast("double").alias("y"), "prob_pos")

    best, scored = 0.5, None
    if exists(spark, path["processed"]):
        folds = spark.read.parquet(path["rolling_windows"])
        for (fold,) in folds.select("fold").distinct().orderBy("fold").collect():  # a handful of folds
            part = [spark.read.parquet(f"{path['processed']}/fold={fold}/role={r}") for r in ("train", "val")]
            s = fitted(*part).withColumn("fold", F.lit(fold))
            scored = s if scored is None else scored.unionByName(s)
    if scored is not None:
        sweep = EV.threshold_sweep(scored, "y", "prob_pos", thresholds, by="fold").persist()
        best = sweep.groupBy("threshold").agg(F.avg("f2").alias("f2")).orderBy(F.desc("f2"), "threshold").first()["threshold"]
        IO.log_metrics(sweep.filter(F.col("threshold") == best).withColumn("step", F.lit(0)), path["metrics"], run_id,
                       metric_cols=["precision", "recall", "f1", "f2", "threshold"])
        sweep.unpersist()
    train, test = (spark.read.parquet(f"{path['processed_train_test']}/split={s}") for s in ("train", "test"))
    blind = fitted(train, test).withColumn("pred", (F.col("prob_pos") >= best).cast("int"))
    result = EV.classification_metrics(blind, "y", "pred", "prob_pos").withColumn("threshold", F.lit(float(best)))
    result = result.withColumns({"fold": F.lit(-1), "step": F.lit(0)})
    IO.log_metrics(result, path["metrics"], run_id)
    return result


def exists(spark, path: str) -> bool:
    """Whether a stage was written (through the path's own file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

