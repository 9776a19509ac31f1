"""Ordered-neighbour joins: backward as-of join (J7), match rate (J8), nearest
candidate per key (J3).

All three are the same plan: union the query rows and the candidate rows, shuffle
once on ``(key, bucket)``, sort inside each partition and read the latest candidate
seen so far with ``last(struct, ignorenulls)`` over a running frame.  Output size
equals the query side; no candidate pairs are ever materialised.

Skew: a hot key is split into buckets of the ordering value (time or value).  The
last candidate of each earlier bucket is carried into the next one as one extra
row, so a left row only needs its own bucket.  When a tolerance bounds the look-
back, the bucket width defaults to the tolerance and the carry comes from the
previous bucket only; without a tolerance the carry is found on a per-bucket
summary (one row per non-empty bucket), which is small.
"""

from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = "__k{}"


def _as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def _interval(seconds: float) -> Column:
    s = int(seconds) if float(seconds).is_integer() else float(seconds)
    return F.expr(f"INTERVAL '{s}' SECOND")


def _is_time(dt: T.DataType) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))


def _micros(c: Column, dt: T.DataType) -> Column:
    """Zone-free microseconds of a time value."""
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    # unix_timestamp reads NTZ as wall clock (zone-free) and zoned values as instants
    part = F.date_part(F.lit("SECOND"), c)
    return F.unix_timestamp(c) * F.lit(1_000_000) + ((part - F.floor(part)) * F.lit(1_000_000)).cast("long")


def _bucket_of(c: Column, dt: T.DataType, width: float) -> Column:
    """Bucket of an ordering value; the width is in seconds for time types and never
    rounds below a microsecond, so a bucket is at least as wide as a tolerance."""
    if _is_time(dt):
        return F.floor(_micros(c, dt) / F.lit(math.ceil(width * 1e6))).cast("long")
    return F.floor(c.cast("double") / float(width)).cast("long")


def _descending(c: Column, dt: T.DataType) -> Column:
    return -(_micros(c, dt) if _is_time(dt) else c.cast("double"))


def _null_struct(schema: T.StructType) -> Column:
    return F.lit(None).cast(schema)


def _neighbour(
    L: DataFrame,
    R: DataFrame,
    nkeys: int,
    t_type: T.DataType,
    direction: str,
    bucket_width: float | None,
    bounded: bool,
    inclusive: bool = True,
) -> DataFrame:
    """Core lookup on prepared frames.

    ``L`` has columns ``__k0..``, ``_t``, ``_l`` (struct);  ``R`` has ``__k0..``,
    ``_t``, ``_tb`` (tie-break, smaller wins among equal ``_t``), ``_r`` (struct).
    Returns ``L``'s ``_l`` plus ``_back`` and/or ``_fwd`` structs (the chosen
    candidate rows, ``_r`` with ``_t`` folded in as ``__t``).
    """
    keys = [_KEY.format(i) for i in range(nkeys)]
    tb_type = R.schema["_tb"].dataType
    r_schema = R.schema["_r"].dataType
    l_schema = L.schema["_l"].dataType
    want_back = direction in ("backward", "nearest")
    want_fwd = direction in ("forward", "nearest")

    if bucket_width:
        bexpr = _bucket_of(F.col("_t"), t_type, bucket_width)
    else:
        bexpr = F.lit(0).cast("long")
    # rows that can never match (NULL key or ordering value) arrive with NULL keys
    # and a hash-spread bucket in ``_nb``: they ride along in the same shuffle,
    # spread over many partitions, and meet no candidate there
    L = L.withColumn("_b", F.coalesce(F.col("_nb"), bexpr) if "_nb" in L.columns else bexpr)
    R = R.withColumn("_b", bexpr)

    # Right rows: _s = 0 before queries at equal value (inclusive), 2 after (strict).
    rs = 0 if inclusive else 2
    parts = [
        L.select(*keys, "_b", "_t", F.lit(1).alias("_s"), F.lit(None).cast(tb_type).alias("_tb"),
                 "_l", _null_struct(r_schema).alias("_r")),
        R.select(*keys, "_b", "_t", F.lit(rs).alias("_s"), "_tb", _null_struct(l_schema).alias("_l"), "_r"),
    ]

    if bucket_width:
        rec = F.struct("_t", "_tb", "_r")
        # largest value, then smallest tie-break (NULL first): the window's order, for any
        # type of tie-break
        last_key = F.struct(_descending(F.col("_t"), t_type).alias("t"), F.col("_tb"))
        aggs = ([F.min_by(rec, last_key).alias("_last")] if want_back else []) + \
               ([F.min_by(rec, F.struct("_t", "_tb")).alias("_first")] if want_fwd else [])
        summary = R.groupBy(*keys, "_b").agg(*aggs)
        carries = []
        if bounded:
            # width >= tolerance: only the adjacent bucket can hold a match; the last
            # candidate moves to the next bucket, the first to the previous one
            moves = []
            if want_back:
                moves.append(F.struct((F.col("_b") + 1).alias("b"), F.col("_last").alias("c")))
            if want_fwd:
                moves.append(F.struct((F.col("_b") - 1).alias("b"), F.col("_first").alias("c")))
            mv = summary.select(*keys, F.explode(F.array(*moves)).alias("_m"))
            carries.append(mv.select(*keys, F.col("_m.b").alias("_b"), F.col("_m.c").alias("_c")))
        else:
            # one window pass over (summary rows + left-bucket markers) per key gives
            # both carries: markers sort before the summary row of their own bucket,
            # so running last() sees strictly earlier (or, descending, later) buckets
            marks = (L.filter(F.col("_nb").isNull()) if "_nb" in L.columns else L).select(*keys, "_b").distinct()
            st = summary.schema
            sides = [c for c in ("_last", "_first") if c in st.fieldNames()]
            x = summary.select(*keys, "_b", F.lit(1).alias("_o"), *sides).unionByName(
                marks.select(*keys, "_b", F.lit(0).alias("_o"), *[F.lit(None).cast(st[c].dataType).alias(c) for c in sides]))
            run = (Window.unboundedPreceding, 0)
            if want_back:
                wbk = Window.partitionBy(*keys).orderBy("_b", "_o").rowsBetween(*run)
                x = x.withColumn("_cb", F.last("_last", ignorenulls=True).over(wbk))
            if want_fwd:
                wfk = Window.partitionBy(*keys).orderBy(F.col("_b").desc(), "_o").rowsBetween(*run)
                x = x.withColumn("_cf", F.last("_first", ignorenulls=True).over(wfk))
            got = [F.col(c) for c, w in (("_cb", want_back), ("_cf", want_fwd)) if w]
            carries.append(x.filter(F.col("_o") == 0)
                           .select(*keys, "_b", F.explode(F.array(*got)).alias("_c"))
                           .filter(F.col("_c").isNotNull()))
        for c in carries:
            parts.append(c.select(*keys, "_b", F.col("_c._t").alias("_t"), F.lit(rs).alias("_s"),
                                  F.col("_c._tb").alias("_tb"), _null_struct(l_schema).alias("_l"),
                                  F.col("_c._r").alias("_r")))

    U = parts[0]
    for p in parts[1:]:
        U = U.unionByName(p)

    cand = F.when(F.col("_r").isNotNull(), F.struct(F.col("_t").alias("__t"), F.col("_tb").alias("__tb"), F.col("_r").alias("__r")))
    U = U.withColumn("_cand", cand)
    out_cols = []
    if want_back:
        wb = (Window.partitionBy(*keys, "_b").orderBy(F.col("_t").asc(), F.col("_s").asc(), F.col("_tb").desc())
              .rowsBetween(Window.unboundedPreceding, 0))
        U = U.withColumn("_back", F.last("_cand", ignorenulls=True).over(wb))
        out_cols.append("_back")
    if want_fwd:
        # strict forward puts right rows after queries at equal value as well
        wf = (Window.partitionBy(*keys, "_b").orderBy(F.col("_t").desc(), F.col("_s").asc(), F.col("_tb").desc())
              .rowsBetween(Window.unboundedPreceding, 0))
        U = U.withColumn("_fwd", F.last("_cand", ignorenulls=True).over(wf))
        out_cols.append("_fwd")
    return U.filter(F.col("_s") == 1).select("_l", *out_cols)


NULL_SPREAD = 1024  # buckets over which never-matching (NULL key) rows are spread


def _left_frame(left: DataFrame, by: list[str], order_col: Column, lcols: list[str]) -> DataFrame:
    """``__k*``, ``_t``, ``_l``, ``_nb`` for the query side, in one pass: rows with a
    NULL key or ordering value get NULL keys and a spread bucket instead of being
    split off into a second scan of ``left``."""
    ok = F.lit(True)
    for c in by:
        ok = ok & F.col(c).isNotNull()
    ok = ok & order_col.isNotNull()
    spread = F.pmod(_row_hash(left, lcols), F.lit(NULL_SPREAD)).cast("long")
    return left.select(
        *[F.when(ok, F.col(c)).alias(_KEY.format(i)) for i, c in enumerate(by)],
        F.when(ok, order_col).alias("_t"),
        F.struct(*[F.col(c) for c in lcols]).alias("_l"),
        F.when(~ok, -1 - spread).alias("_nb"),
    )


def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    return True


def _row_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    """xxhash64 over the hashable columns (map types are not hashable)."""
    ok = [F.col(f"`{c}`") for c in cols if _hashable(df.schema[c].dataType)]
    return F.xxhash64(*ok) if ok else F.lit(0).cast("long")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_ts: str,
    right_ts: str,
    *,
    right_by: str | Sequence[str] | None = None,
    offset_s: float = 0,
    tolerance_s: float | None = None,
    right_cols: Iterable[str] | None = None,
    tiebreak: str | None = None,
    prefix: str = "",
    target_col: str = "asof_target_ts",
    matched_col: str = "matched_ts",
    bucket_s: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Backward as-of join.

    For every left row, attach the latest right row with the same key and
    ``right_ts <= left_ts - offset`` (``<`` if not ``inclusive``) and, if given,
    ``(left_ts - offset) - right_ts <= tolerance``.  Left rows are never dropped or
    duplicated; unmatched rows get NULL right columns.  NULL keys never match.
    Equal right timestamps: the row with the smallest ``tiebreak`` wins (NULL is the
    smallest; default: a hash of the row).

    ``bucket_s`` splits each key into time buckets (default: the tolerance) so a hot
    key is spread over many tasks.
    """
    by = _as_list(by)
    right_by = _as_list(right_by) or by
    if len(by) != len(right_by):
        raise ValueError("by and right_by must have the same length")
    if right_cols is None:
        right_cols = [c for c in right.columns if c not in set(right_by) | {right_ts}]
    right_cols = list(right_cols)
    if bucket_s is None and tolerance_s is not None:
        bucket_s = tolerance_s
    if bucket_s is not None and tolerance_s is not None and bucket_s < tolerance_s:
        raise ValueError("bucket_s must be >= tolerance_s")

    lt_type = left.schema[left_ts].dataType
    target = F.col(left_ts) - _interval(offset_s) if offset_s else F.col(left_ts)
    left2 = left.withColumn(target_col, target)
    lcols = left2.columns

    r_ok = F.lit(True)
    for c in right_by:
        r_ok = r_ok & F.col(c).isNotNull()
    r_ok = r_ok & F.col(right_ts).isNotNull()

    L = _left_frame(left2, by, F.col(target_col), lcols)
    # without a tie-break of its own, a row's hash decides: the same on any partitioning
    tb = F.col(tiebreak) if tiebreak else _row_hash(right, right.columns)
    R = right.filter(r_ok).select(
        *[F.col(c).cast(left.schema[by[i]].dataType).alias(_KEY.format(i)) for i, c in enumerate(right_by)],
        F.col(right_ts).cast(lt_type).alias("_t"),
        tb.alias("_tb"),
        F.struct(*[F.col(c).alias(prefix + c) for c in right_cols]).alias("_r"),
    )
    res = _neighbour(L, R, len(by), lt_type, "backward", bucket_s, tolerance_s is not None, inclusive)

    m = F.col("_back")
    ok = m.isNotNull()
    if tolerance_s is not None:
        ok = ok & (m["__t"] >= F.col("_l")[target_col] - _interval(tolerance_s))
    r_fields = [prefix + c for c in right_cols]
    return res.select(
        "_l.*",
        F.when(ok, m["__t"]).cast(lt_type).alias(matched_col),
        *[F.when(ok, m["__r"][f]).alias(f) for f in r_fields],
    )


def match_rate(df: DataFrame, col: str) -> DataFrame:
    """(matched, total) in one aggregate pass."""
    return df.agg(F.count(F.col(col)).alias("matched"), F.count(F.lit(1)).alias("total"))


def nearest_per_key(
    left: DataFrame,
    cands: DataFrame,
    by: str | Sequence[str],
    left_value: str,
    cand_value: str,
    cand_id: str,
    *,
    cand_by: str | Sequence[str] | None = None,
    cand_cols: Iterable[str] | None = None,
    prefix: str = "",
    distance_col: str = "distance",
    bucket_width: float | None = None,
    max_distance: float | None = None,
) -> DataFrame:
    """Nearest candidate per key by ``|left_value - cand_value|``.

    Every left row gets the candidate of the same key with the smallest absolute
    difference; ties on distance go to the smallest ``cand_id``.  Implemented as a
    two-sided ordered lookup (predecessor and successor by value) on one shuffle,
    so no left x candidate pairs are produced.  ``bucket_width`` splits hot keys by
    value range.
    """
    by = _as_list(by)
    cand_by = _as_list(cand_by) or by
    if cand_cols is None:
        cand_cols = [c for c in cands.columns if c not in set(cand_by)]
    cand_cols = list(cand_cols)
    lcols = left.columns
    ck = F.lit(True)
    for c in cand_by:
        ck = ck & F.col(c).isNotNull()
    ck = ck & F.col(cand_value).isNotNull()

    L = _left_frame(left, by, F.col(left_value).cast("double"), lcols)
    R = cands.filter(ck).select(
        *[F.col(c).cast(left.schema[by[i]].dataType).alias(_KEY.format(i)) for i, c in enumerate(cand_by)],
        F.col(cand_value).cast("double").alias("_t"),
        F.col(cand_id).alias("_tb"),
        F.struct(*[F.col(c).alias(prefix + c) for c in cand_cols]).alias("_r"),
    )
    bounded = max_distance is not None and bucket_width is not None and bucket_width >= max_distance
    res = _neighbour(L, R, len(by), T.DoubleType(), "nearest", bucket_width, bounded)
    lv = F.col("_l")[left_value].cast("double")
    db = lv - F.col("_back")["__t"]
    df_ = F.col("_fwd")["__t"] - lv
    take_back = F.col("_fwd").isNull() | (
        F.col("_back").isNotNull() & ((db < df_) | ((db == df_) & (F.col("_back")["__tb"] <= F.col("_fwd")["__tb"]))))
    pick = F.when(take_back, F.col("_back")).otherwise(F.col("_fwd"))
    dist = F.when(take_back, db).otherwise(df_)
    ok = pick.isNotNull()
    if max_distance is not None:
        ok = ok & (dist <= float(max_distance))
    fields = [prefix + c for c in cand_cols]
    return res.select("_l.*", *[F.when(ok, pick["__r"][f]).alias(f) for f in fields],
                      F.when(ok, dist).alias(distance_col))
