"""Presets: the calendar rule and the flight pipeline's configuration values."""

from __future__ import annotations

import datetime as dt


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> dt.date:
    d = dt.date(year, month, 1)
    d += dt.timedelta(days=(weekday - d.weekday()) % 7)
    return d + dt.timedelta(weeks=n - 1)


def _last_weekday(year: int, month: int, weekday: int) -> dt.date:
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    d = nxt - dt.timedelta(days=1)
    return d - dt.timedelta(days=(d.weekday() - weekday) % 7)


def us_holidays(first_year: int, last_year: int) -> list[tuple[str, str]]:
    """Federal-holiday calendar by rule (no observed-day shifts), plus Christmas Eve;
    for 2015-2019 this is exactly the source pipeline's literal calendar."""
    MON, THU = 0, 3
    out = []
    for y in range(first_year, last_year + 1):
        out += [
            (dt.date(y, 1, 1), "New Year's Day"),
            (_nth_weekday(y, 1, MON, 3), "Martin Luther King Jr. Day"),
            (_nth_weekday(y, 2, MON, 3), "Presidents Day"),
            (_last_weekday(y, 5, MON), "Memorial Day"),
            (dt.date(y, 7, 4), "Independence Day"),
            (_nth_weekday(y, 9, MON, 1), "Labor Day"),
            (_nth_weekday(y, 10, MON, 2), "Columbus Day"),
            (dt.date(y, 11, 11), "Veterans Day"),
            (_nth_weekday(y, 11, THU, 4), "Thanksgiving Day"),
            (dt.date(y, 12, 24), "Christmas Eve"),
            (dt.date(y, 12, 25), "Christmas Day"),
        ]
    return [(d.isoformat(), n) for d, n in out]


# --- fixed values: the flight pipeline's configuration
AIRPORTS_TO_REMOVE = ["BQN", "STT", "GUM", "SJU", "ISN", "PSE", "PPG", "STX"]
ASOF_OFFSET_H, ASOF_TOLERANCE_H = 1, 8
LAG_LEAD_S = 3661
ALTIMETER_STANDARD = 29.92
ZERO_FILL = [
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "overall_cloud_frac_0_1", "lowest_cloud_ft", "highest_cloud_ft", "has_few", "has_sct", "has_bkn", "has_ovc",
    "HourlyWindDirection", "HourlyWindSpeed", "HourlyWindGustSpeed",
    "light", "heavy", "thunderstorm", "rain_or_drizzle", "freezing_conditions", "snow", "hail_or_ice",
    "reduced_visibility", "spatial_effects", "unknown_precip",
    "origin_pagerank", "dest_pagerank", "origin_out_degree", "dest_in_degree",
    "prev_flight_arr_delay_clean", "actual_to_crs_time_to_next_flight_diff_mins_clean",
]
MEDIAN_FILL = ["crs_time_to_next_flight_diff_mins"]
NUM_COLS = [
    "CRS_ELAPSED_TIME", "DISTANCE", "ORIGIN_LAT", "ORIGIN_LONG", "ORIGIN_ELEVATION_FT",
    "DEST_LAT", "DEST_LON", "DEST_ELEVATION_FT", "overall_cloud_frac_0_1", "lowest_cloud_ft", "highest_cloud_ft",
    "HourlyAltimeterSetting", "HourlyWindGustSpeed", "HourlyWindSpeed",
    "origin_pagerank", "dest_pagerank", "origin_out_degree", "dest_in_degree",
    "prev_flight_arr_delay_clean", "crs_time_to_next_flight_diff_mins", "actual_to_crs_time_to_next_flight_diff_mins_clean",
]
LOG_CANDIDATES = [
    "CRS_ELAPSED_TIME", "DISTANCE", "ORIGIN_ELEVATION_FT", "DEST_ELEVATION_FT", "lowest_cloud_ft", "highest_cloud_ft",
    "HourlyWindGustSpeed", "HourlyWindSpeed", "origin_out_degree", "dest_in_degree",
    "crs_time_to_next_flight_diff_mins", "actual_to_crs_time_to_next_flight_diff_mins_clean",
]
BINARY_COLS = [
    "IS_US_HOLIDAY", "has_few", "has_sct", "has_bkn", "has_ovc", "light", "heavy", "thunderstorm", "rain_or_drizzle",
    "freezing_conditions", "snow", "hail_or_ice", "reduced_visibility", "spatial_effects", "unknown_precip",
]
CAT_COLS = ["OP_UNIQUE_CARRIER", "ORIGIN", "ORIGIN_STATE_ABR", "DEST", "DEST_STATE_ABR", "ORIGIN_SIZE", "DEST_SIZE",
            "HourlyWindCardinalDirection"]
CYCLICAL_COLS = ["QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "CRS_DEP_TIME_BLOCK", "CRS_ARR_TIME_BLOCK"]
SWEEP_THRESHOLDS = [0.45, 0.50, 0.55, 0.65, 0.75, 0.80, 0.85]
BASELINE_PR_AUC, BASELINE_F1 = 0.6833, 0.6343
EARLY_STOP_PATIENCE, EARLY_STOP_MIN_DELTA = 2, 1e-4
OVERFIT_GAP = 0.1
