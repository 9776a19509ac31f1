"""Clock and calendar algebra on HHMM integers and zone-free timestamps.

All results are ``timestamp_ntz`` (wall clock) unless a zone conversion is asked
for; nothing depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: clock conventions of the source data
MIDNIGHT_END = 2400          # "24:00" written by the source for end-of-day times
HOUR_BLOCK_FORMAT = "%02d00-%02d59"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_2400(c) -> Column:
    """2400 -> 0, other values unchanged."""
    c = _col(c)
    return F.when(c == MIDNIGHT_END, F.lit(0)).otherwise(c)


def hhmm_int(c) -> Column:
    """HHMM as int (934.0 -> 934); casting first avoids lpad('934.0') = '934.'."""
    return _col(c).try_cast("double").cast("int")


def hour_of(c) -> Column:
    """Hour from HHMM: first two digits of the 4-padded value (2400 -> 24)."""
    return F.substring(F.lpad(hhmm_int(c).cast("string"), 4, "0"), 1, 2).cast("int")


def hour_block(c) -> Column:
    """HHMM -> '0100-0159' style hour block."""
    h = F.floor(_col(c) / 100).cast("int")
    return F.format_string(HOUR_BLOCK_FORMAT, h, h)


def compose_timestamp(date_col, hhmm) -> Column:
    """Date + HHMM -> wall-clock ``timestamp_ntz`` (NULL when not a valid time).
    2400 is first normalised to 0 on the same date (callers roll the date, X4)."""
    d = _col(date_col).cast("date")
    v = normalize_2400(hhmm_int(hhmm))
    return F.try_make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                    F.floor(v / 100).cast("int"), (v % 100).cast("int"), F.lit(0))


def infer_event_dates(fl_date, dep_time, crs_dep_time, dep_delay, arr_time, crs_arr_time,
                      compat: bool = False) -> dict[str, Column]:
    """Calendar roll-over for departure, arrival and scheduled arrival dates.

    * departure is next day if it left before its scheduled clock time while late,
      or at 2400;
    * arrival is next day (relative to the departure date) if it lands before its
      departure clock time, or at 2400; otherwise it keeps the departure date.
      ``compat=True`` reproduces the source's fallback to the scheduled date.
    * scheduled arrival is next day if before the scheduled departure, or at 2400.
    """
    fl = _col(fl_date).cast("date")
    dep, crs_dep, delay = _col(dep_time), _col(crs_dep_time), _col(dep_delay)
    arr, crs_arr = _col(arr_time), _col(crs_arr_time)
    dep_date = F.when(((dep < crs_dep) & (delay > 0)) | (dep == MIDNIGHT_END), F.date_add(fl, 1)).otherwise(fl)
    arr_next = (arr < dep) | (arr == MIDNIGHT_END)
    arr_date = F.when(arr_next, F.date_add(dep_date, 1)).otherwise(fl if compat else dep_date)
    crs_arr_date = F.when((crs_arr < crs_dep) | (crs_arr == MIDNIGHT_END), F.date_add(fl, 1)).otherwise(fl)
    return {"DEP_DATE": dep_date, "ARR_DATE": arr_date, "CRS_ARR_DATE": crs_arr_date}


def to_utc(ts, zone) -> Column:
    """Wall clock in ``zone`` (column of IANA names, or ``F.lit(name)``) -> UTC
    wall clock (NTZ)."""
    return F.convert_timezone(_col(zone), F.lit("UTC"), _col(ts).cast("timestamp_ntz"))


def split_pair(c, sep: str = ",") -> tuple[Column, Column]:
    """X8: "a,b" -> (double a, double b); malformed parts give NULL."""
    parts = F.split(_col(c), sep)
    return (F.trim(F.get(parts, 0)).try_cast("double"), F.trim(F.get(parts, 1)).try_cast("double"))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 (wall clock for NTZ, instant for zoned)."""
    return F.unix_timestamp(_col(ts))


def minus_seconds(ts, seconds: float) -> Column:
    """Timestamp minus a fixed number of seconds (interval arithmetic)."""
    s = int(seconds) if float(seconds).is_integer() else float(seconds)
    return _col(ts) - F.expr(f"INTERVAL '{s}' SECOND")
