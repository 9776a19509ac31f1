"""Derived fixture tables, written once as SQL expressions and evaluated by both
engines (Spark ``selectExpr`` and the DuckDB oracle) so inputs are identical.

Every fixture is a row-wise projection of a driver table: its size grows with
the table; no rows are filtered out to make anything cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventfeat.plans.tables import table

# HHMM helpers on minutes-of-day (m may be negative or >= 1440 before wrapping).
_WRAP = "((({m}) % 1440 + 1440) % 1440)"


def _hhmm(m: str) -> str:
    w = _WRAP.format(m=m)
    return f"CAST(floor({w} / 60) * 100 + {w} % 60 AS INT)"


_MIN = "(hour(ts) * 60 + minute(ts))"
_DELAY = "(CAST(floor(value) AS INT) - 20)"
_DUR = "(60 + CAST(user_id % 300 AS INT))"

# --- fixed values: coded weather strings; rows pick one by event_id % len
WX_STRINGS = [
    "", "RA", "-RA:02 BR:1", "+TSRA", "-TSRA:02", "TS:7", "VCTS:7", "FZFG:2", "MIFG", "SN BLSN",
    "|RA:02|", "null", "UP:01", "SHSN GS", "SQ", "PR", "BCFG", "HZ FU", "DZ|BR", "FZRA:3 IC",
    "VCSH", "DRSN:9", "+SN:07 FZ", "GR", "*",
]
SKY_STRINGS = [
    "", "FEW:02 025", "SCT:04 030 BKN:07 080", "OVC:08 012", "VV:09 012", "BKN:07 050 OVC:08 100",
    "CLR:00", "FEW:01 010 SCT:03 020 BKN:05 030 OVC:08 040", "BKN:06", "050", "null", "SCT:04 030|BKN:07 080",
    "OVC:08 008 *", "FEW:02 025 SCT:04",
]
ZONES4 = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"]


def _pick(lst: list[str], idx: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(lst))
    return f"CASE CAST({idx} % {len(lst)} AS INT) {arms} END"


FIXTURES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    # flights-like clock fields from events (2400 injected by key modulo)
    "ev_clock": ("events", [
        ("event_id", "event_id"),
        ("user_id", "user_id"),
        ("ts", "ts"),
        ("fl_date", "CAST(ts AS DATE)"),
        ("crs_dep", f"CASE WHEN event_id % 50 = 0 THEN 2400 ELSE {_hhmm(_MIN)} END"),
        ("dep_delay", _DELAY),
        ("dep_time", f"CASE WHEN event_id % 97 = 0 THEN 2400 ELSE {_hhmm(_MIN + ' + ' + _DELAY)} END"),
        ("crs_arr", f"CASE WHEN event_id % 89 = 0 THEN 2400 ELSE {_hhmm(_MIN + ' + ' + _DUR)} END"),
        ("arr_time", f"CASE WHEN event_id % 83 = 0 THEN 2400 ELSE {_hhmm(_MIN + ' + ' + _DUR + ' + ' + _DELAY)} END"),
        ("zone", _pick(ZONES4, "user_id")),
        ("degrees", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 361 AS INT) END"),
        ("coords", "CAST(CAST(user_id % 90 AS INT) AS STRING) || ', ' || CAST(CAST(event_id % 180 AS INT) - 90 AS STRING)"),
        ("flag", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 2 AS INT) END"),
        ("label", "CASE WHEN event_id % 4 = 0 THEN NULL WHEN value >= 60 THEN 1 ELSE 0 END"),
        ("actual_min", "value"),
        ("sched_min", "CAST(user_id % 40 AS DOUBLE)"),
        ("alt", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END"),
        ("sea", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value + 1 END"),
        ("stn", "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value + 2 END"),
    ]),
    # coded text from a literal list of quirks, picked per event
    "ev_codes": ("events", [
        ("event_id", "event_id"),
        ("wx", _pick(WX_STRINGS, "event_id")),
        ("sky", _pick(SKY_STRINGS, "event_id")),
    ]),
    # orders with NULLs injected and messy strings
    "orders_dirty": ("orders", [
        ("o_orderkey", "o_orderkey"),
        ("o_custkey", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END"),
        ("o_totalprice", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END"),
        ("o_orderpriority", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END"),
        ("o_rate", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice / 100.0 + 0.5) / 100 END"),
        ("o_orderdate", "o_orderdate"),
        ("price_str", "CASE WHEN o_orderkey % 7 = 0 THEN 'VRB' ELSE CAST(o_totalprice AS STRING) END"),
        ("prio_str", "CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE substr(o_orderpriority, 1, 1) END"),
    ]),
    # scored table: score from a hash of the key, 2 decimals (ties occur)
    "orders_scored": ("orders", [
        ("o_orderkey", "o_orderkey"),
        ("fold", "o_orderpriority"),
        ("y", "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"),
        # 2-decimal rounding written as floor(x*100 + 0.5)/100: bit-identical in both engines
        ("score", "floor((CAST(conv(substr(md5('7:' || CAST(o_orderkey AS STRING)), 1, 8), 16, 10) AS BIGINT) / 4294967296.0"
                  " + CASE WHEN o_orderstatus = 'F' THEN 0.35 ELSE 0.0 END) / 1.35 * 100 + 0.5) / 100"),
    ]),
    # per-(fold, step) metric log derived from orders: fold = year, step = month
    "orders_metrics": ("orders", [
        ("o_orderkey", "o_orderkey"),
        ("fold", "CAST(year(o_orderdate) - 1994 AS INT)"),
        ("step", "CAST(month(o_orderdate) AS INT)"),
        ("is_f", "CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END"),
        ("is_fo", "CASE WHEN o_orderstatus IN ('F', 'O') THEN 1.0 ELSE 0.0 END"),
    ]),
}

# DuckDB spelling of the few functions that differ
_DUCK = [("CAST(conv(substr(md5(", "CAST(('0x' || substr(md5("), (", 1, 8), 16, 10) AS BIGINT)", ", 1, 8)) AS BIGINT)")]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, cols = FIXTURES[name]
    return table(spark, sf_dir, base).selectExpr(*[f"{e} AS {a}" for a, e in cols])


def fixture_sql(name: str) -> str:
    base, cols = FIXTURES[name]
    body = ", ".join(f"{e} AS {a}" for a, e in cols)
    for a, b in _DUCK:
        body = body.replace(a, b)
    return f"(SELECT {body} FROM {base})"


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named fixtures (merging a leading WITH)."""
    ctes = ", ".join(f"{n} AS {fixture_sql(n)}" for n in names)
    body = sql.lstrip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes}, {body[14:]}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes}, {body[4:]}"
    return f"WITH {ctes} {body}"
