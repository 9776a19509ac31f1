"""Projection, filtering and keying of fact tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """keep-list projection; duplicates in the list are tolerated (first wins)."""
    return df.select(*dict.fromkeys(cols))


def between_dates(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """inclusive range filter (pushed to the scan as two comparisons)."""
    return df.filter(F.col(col).between(F.lit(lo).cast(df.schema[col].dataType), F.lit(hi).cast(df.schema[col].dataType)))


def exclude(df: DataFrame, not_in: Mapping[str, Iterable] | None = None,
            equals: Mapping[str, object] | None = None) -> DataFrame:
    """conjunctive filter: ``col == value`` for ``equals`` and ``col NOT IN values``
    for ``not_in``.  (NULL in an excluded column drops the row, as in SQL.)"""
    cond = F.lit(True)
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    for c, vs in (not_in or {}).items():
        cond = cond & ~F.col(c).isin(list(vs))
    return df.filter(cond)


def contains(df: DataFrame, col: str, text: str) -> DataFrame:
    """substring filter."""
    return df.filter(F.col(col).contains(text))


def require(df: DataFrame, not_null: Sequence[str] = (), lengths: Mapping[str, int] | None = None) -> DataFrame:
    """validity filter: listed columns not NULL and exact string lengths."""
    cond = F.lit(True)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for c, n in (lengths or {}).items():
        cond = cond & (F.length(F.col(c)) == n)
    return df.filter(cond)


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Keep rows whose key occurs in ``keys`` (left-semi join; no driver
    collect, no IN-list).  ``on`` may map df columns to key columns."""
    if isinstance(on, Mapping):
        cond = None
        for a, b in on.items():
            e = df[a] == keys[b]
            cond = e if cond is None else cond & e
        return df.join(keys, cond, "left_semi")
    return df.join(keys, on=list([on] if isinstance(on, str) else on), how="left_semi")


def compose_key(parts: Sequence[str | Column], pads: Mapping[int, int] | None = None, sep: str = "_",
                null_token: str | None = "") -> Column:
    """surrogate key ``a_b_c``; ``pads`` zero-pads part i to a width (HHMM).
    NULL parts become ``null_token`` so positions stay aligned (concat_ws would
    silently drop them); pass ``null_token=None`` to reproduce dropping."""
    cols = []
    for i, p in enumerate(parts):
        c = (F.col(p) if isinstance(p, str) else p).cast("string")
        if pads and i in pads:
            c = F.lpad(c, pads[i], "0")
        if null_token is not None:
            c = F.coalesce(c, F.lit(null_token))
        cols.append(c)
    return F.concat_ws(sep, *cols)


def dedup(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """F8: de-duplicate full rows (or on a subset; then an arbitrary row survives)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def time_slice(df: DataFrame, col: str, start, end) -> DataFrame:
    """half-open slice ``start <= col < end``."""
    dt = df.schema[col].dataType
    return df.filter((F.col(col) >= F.lit(start).cast(dt)) & (F.col(col) < F.lit(end).cast(dt)))


def with_prefix(df: DataFrame, prefix: str = "", cols: Sequence[str] | None = None, suffix: str = "",
                drop: Sequence[str] = ()) -> DataFrame:
    """bulk rename with prefix/suffix (one projection) and bulk drop."""
    cols = list(cols) if cols is not None else df.columns
    out = df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in cols})
    return out.drop(*drop) if drop else out


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """type coercion with ``try_cast`` (bad strings become NULL under ANSI);
    columns not present are skipped."""
    have = set(df.columns)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in have})
