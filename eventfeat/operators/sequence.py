"""Per-entity sequence features.

``lag_features`` is the workhorse: the previous event of the same entity.  Entities are
split into time buckets, and only the first and last row of each bucket meet, so no task
ever holds a whole entity.  NULL entities never borrow a lag from unrelated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventfeat.functions.timecols import epoch_seconds
from eventfeat.sources.io import scratch_path
from eventfeat.operators.asof import _row_hash


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def top1(df: DataFrame, by: str | Sequence[str], order: str | Sequence[str], descending: bool = True) -> DataFrame:
    """One row per group, the one with the greatest (or least) ``order`` tuple.

    An aggregate (``max_by`` over a struct), not a ranked window: it is combined
    map-side before the shuffle, so a hot group costs one row per partition."""
    by, order = _list(by), _list(order)
    rec = F.struct(*[F.col(c) for c in df.columns])
    key = F.struct(*[F.col(c) for c in order])
    pick = F.max_by(rec, key) if descending else F.min_by(rec, key)
    return df.groupBy(*by).agg(pick.alias("_top")).select("_top.*")


#: width of the time buckets of an entity where the caller names none
BUCKET_S = 30 * 86400


def lag_features(df: DataFrame, by: str | Sequence[str], order: str | Sequence[str], cols: Sequence[str],
                 prefix: str = "prev_", bucket_s: float | str | None = "auto") -> DataFrame:
    """Previous row's ``cols`` per entity (ordered by ``order``, NULL first; give a
    unique tie-break as the last order column).  Output: ``prefix + col`` for each col.

    Rows are dealt by entity and bucket of ``bucket_s`` seconds of the first order column
    (``"auto"``: 30 days of a date or timestamp, one bucket for other types; ``None``: one
    bucket), so an entity with a third of all rows spreads over its buckets.  Only the first
    and last row of each bucket meet per entity, where a bucket's first row finds the last
    row of the nearest earlier one.  Both steps read the same exchange: the input runs once.
    The result does not depend on ``bucket_s``.  NULL entities get no lag."""
    by, order = _list(by), _list(order)
    cols = list(cols)
    key_ok = F.lit(True)
    for c in by:
        key_ok = key_ok & F.col(c).isNotNull()
    if bucket_s == "auto":
        bucket_s = BUCKET_S if df.schema[order[0]].dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else None
    rec = F.struct(*[F.col(c).alias(c) for c in cols])
    # NULL entities stay in the same pass (no second scan of df) but are spread over
    # many partitions and never receive a lag
    spread = F.when(~key_ok, F.pmod(_row_hash(df, df.columns), F.lit(1024))).otherwise(F.lit(-1))
    base = df.withColumn("_ok", key_ok).withColumn("_sp", spread.cast("long"))
    if bucket_s is None:
        w = Window.partitionBy(*by, "_sp").orderBy(*order)
        out = base.withColumn("_prev", F.lag(rec, 1).over(w))
    else:
        b = F.floor(epoch_seconds(F.col(order[0])) / float(bucket_s)).cast("long")
        w = Window.partitionBy(*by, "_sp", "_b").orderBy(*order)
        kb = base.withColumn("_b", b).withColumns({
            "_prev": F.lag(rec, 1).over(w), "_first": F.lag(F.lit(True), 1).over(w).isNull(), "_last": F.lead(F.lit(True), 1).over(w).isNull()})
        # a bucket's first row stands before its last one, which the next bucket looks back
        # at.  Both uses of the exchange must need the same columns and push nothing below
        # it (a condition on the entity would be), or the input would run twice
        ends = Window.partitionBy(*by, "_sp").orderBy(F.col("_b").asc_nulls_first(), F.col("_first").desc())
        opening = kb.filter("_first OR _last").withColumn("_prev", F.coalesce("_prev", F.lag(rec, 1).over(ends))).filter("_first")
        out = kb.filter("NOT _first").unionByName(opening)
    prev = F.when(F.col("_ok"), F.col("_prev"))
    return out.select(*df.columns, *[prev[c].alias(prefix + c) for c in cols])


def safe_lag(df: DataFrame, by, order, ts: str, value: str, known_at: str, lead_s: float = 3661,
             nonneg: bool = True, out: str | None = None, prefix: str = "prev_",
             bucket_s: float | str | None = "auto", keep_prev: bool = False) -> DataFrame:
    """W3 (+W4): leakage-safe lag.

    ``prev_value`` is kept only if the previous event was *known* (``known_at``, e.g.
    its actual arrival) strictly before ``ts - lead_s``; with ``nonneg`` also only if
    the value is >= 0.  Also returns the gap columns of W4:
    ``gap_sched_min`` (ts - previous ``order[0]``-time, minutes, unguarded),
    ``gap_known_min`` (ts - previous known_at, minutes, guarded) and ``gap_known_h``
    (the audit quantity, hours, unguarded)."""
    order = _list(order)
    out = out or f"{prefix}{value}_clean"
    lagged = lag_features(df, by, order, [value, known_at, order[0]] if order[0] != known_at else [value, known_at],
                          prefix="_p_", bucket_s=bucket_s)
    now = epoch_seconds(F.col(ts))
    prev_known = epoch_seconds(F.col(f"_p_{known_at}"))
    safe = prev_known < (now - F.lit(lead_s))
    cond = safe & (F.col(f"_p_{value}") >= 0) if nonneg else safe
    res = lagged.withColumns({
        out: F.when(cond, F.col(f"_p_{value}")),
        "gap_sched_min": (now - epoch_seconds(F.col(f"_p_{order[0]}"))) / 60.0,
        "gap_known_min": F.when(safe, (now - prev_known) / 60.0),
        "gap_known_h": (now - prev_known) / 3600.0,
    })
    drop = [c for c in res.columns if c.startswith("_p_")]
    if keep_prev:
        res = res.withColumnsRenamed({f"_p_{value}": f"{prefix}{value}", f"_p_{known_at}": f"{prefix}{known_at}"})
        drop = [c for c in res.columns if c.startswith("_p_")]
    return res.drop(*drop)


def gap_since_prev(df: DataFrame, by, order, ts: str, unit_s: float = 60.0, out: str = "gap_since_prev",
                   bucket_s: float | str | None = "auto") -> DataFrame:
    """Time since the previous event of the entity, in units of ``unit_s``."""
    order = _list(order)
    lagged = lag_features(df, by, order, [ts], prefix="_gp_", bucket_s=bucket_s)
    return (lagged.withColumn(out, (epoch_seconds(F.col(ts)) - epoch_seconds(F.col(f"_gp_{ts}"))) / float(unit_s))
            .drop(f"_gp_{ts}"))


def ratio_split(df: DataFrame, ts: str, ratios: Sequence[float], names: Sequence[str] = ("train", "val", "test"),
                tiebreak: str | Sequence[str] = (), out: str = "split", partitions: int | None = None) -> DataFrame:
    """Chronological split by row rank: the first ``int(N*r1)`` rows (by ``ts``,
    then ``tiebreak``) are ``names[0]``, the next ``int(N*r2)`` ``names[1]``, ...

    Only the keys ``(ts, tiebreak)`` are ordered: range-partitioned (sampled bounds, so even
    one hot timestamp is split when the tie-break is unique), sorted and written to the
    shared scratch folder with their place, because range bounds are sampled anew whenever a
    plan runs again.  The keys at the cuts follow from the partition counts, and the rows are
    then split by one comparison, without moving them.  The keys are ordered when this
    function is called.  Where a cut falls between rows of equal keys, which no comparison
    can part, the rows themselves are numbered in the same way."""
    tb = _list(tiebreak) if tiebreak else []
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [ts, *tb]
    ranked = _ranked(df.select(*keys), keys, n)
    counts = {r["_pid"]: r["_n"] for r in ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()}  # one row per partition
    total, cuts = sum(counts.values()), []
    for q in ratios:
        cuts.append(int(total * float(q)) + (cuts[-1] if cuts else 0))

    def place(rank: int) -> tuple[int, int]:
        for pid in sorted(counts):
            if rank <= counts[pid]:
                return pid, rank - 1
            rank -= counts[pid]
        raise ValueError(rank)

    def at(rank: int):
        pid, pos = place(rank)
        return (F.col("_pid") == pid) & (F.col("_pos") == pos)

    key = F.struct(*[F.col(c) for c in keys])
    inner = [c for c in cuts if 0 < c < total]
    both = [F.when(at(c) | at(c + 1), F.lit(i)) for i, c in enumerate(inner)]
    if inner and not ranked.select(F.explode(F.array(*both)).alias("cut"), key.alias("k")).filter("cut IS NOT NULL").groupBy("cut").agg(
            F.count_distinct("k").alias("n")).filter("n = 1").isEmpty():
        numbered = _ranked(df, keys, n)
        counts, base = {r["_pid"]: r["_n"] for r in numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()}, 0
        starts = {}
        for pid in sorted(counts):
            starts[pid], base = base, base + counts[pid]
        starts = F.create_map(*[F.lit(x) for p, b in starts.items() for x in (p, b)])
        rank = starts[F.col("_pid")] + F.col("_pos") + 1
        df, conds = numbered, [rank <= c for c in cuts]
    else:
        conds = [F.lit(c >= total) if not 0 < c < total else key <= ranked.filter(at(c)).select(key.alias("k")).scalar() for c in cuts]
    e = None
    for name, cond in zip(names, conds):
        e = F.when(cond, name) if e is None else e.when(cond, name)
    e = e.otherwise(names[len(ratios)] if len(names) > len(ratios) else None)
    return df.withColumn(out, e).drop("_pid", "_pos")


def _ranked(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``df`` in global order of ``keys``, written once, with partition and place inside."""
    r = df.repartitionByRange(n, *[F.col(c) for c in keys]).sortWithinPartitions(*keys).withColumns({
        "_pid": F.spark_partition_id(),
        "_pos": F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)})
    path = scratch_path(df.sparkSession, "ranked")
    r.write.parquet(path)
    return df.sparkSession.read.schema(r.schema).parquet(path)
