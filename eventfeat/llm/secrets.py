"""Secret scans over an incremental blob ledger, native Spark only.

Every text version is a blob addressed by its SHA-256.  The ledger holds one row per
scanned (blob, rule, rule version) with the spans found.  A scan takes the blobs of the
input that some current rule version has not seen yet, scans each blob once whatever the
number of paths that hold it, writes the new ledger rows to the shared folder, and joins
the findings of known and new rows back to all paths.

Spans come from two native calls per rule: ``split`` gives the text between matches and
``regexp_extract_all`` the matches.  The lengths are exploded, and their running sum per
blob and rule gives the code-point positions, in linear time for any number of matches.

Defined results: a null text is the empty blob and has no findings; repeated rows and
null ids each get their own result row; an empty table gives an empty result; extra
columns are ignored.  Overlapping spans of different rules are all reported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventfeat.llm.common import written


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost and non-overlapping; a match counts if its group
    ``group`` has at least ``min_len`` characters.  ``probe`` is a cheap test that every
    text with a match passes."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    min_len: int = 1
    probe: str | None = None


# The base rules of the contract, then rules for other well-known formats.
BASE_RULES = (
    Rule("assign", 1, r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    # a maximal run of 32 or more is the same as a greedy run that has 32 or more
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29, "eyJ"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN "),
)
RULES = BASE_RULES + MORE_RULES

LEDGER_COLUMNS = (("blob", "string"), ("kind", "string"), ("version", "int"),
                  ("spans", "array<struct<start:int,stop:int,ord:int,kind:string>>"))
LEDGER_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in LEDGER_COLUMNS)


def _lengths(text: Column, rule: Rule) -> Column:
    """Per match of one rule ``(gap, hit, size)``: code points between the match before
    and this one, of this match, and of the group that decides."""
    none = F.expr("CAST(array() AS array<struct<gap:int,hit:int,size:int>>)")
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g))
    hits = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda m: F.length(m))
    sizes = (F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m))
             if rule.group else hits)
    found = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), sizes.alias("size"))
    has = F.contains(text, F.lit(rule.probe)) if rule.probe else text.rlike(rule.pattern)
    return F.when(has, found).otherwise(none)


def empty_ledger(spark: SparkSession) -> DataFrame:
    """The ledger before the first scan."""
    return spark.range(0).selectExpr(*[f"CAST(NULL AS {kind}) AS {name}" for name, kind in LEDGER_COLUMNS])


def scan(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Returns ``(paths, entries)``: ``paths`` has one row per input row (``doc_id``,
    ``blob``, ``found``: all spans in order of start, then rule) and ``entries`` the new
    ledger rows to append, one per scanned (blob, rule, version), written already."""
    ledger = empty_ledger(docs.sparkSession) if ledger is None else ledger
    paths = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "blob", F.sha2("text", 256))
    wanted = " OR ".join(f"(kind = '{r.kind}' AND version = {r.version})" for r in rules)
    known = ledger.select("blob", "kind", "version", "spans").filter(wanted)
    seen = known.groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    blobs = paths.select("blob", "text").dropDuplicates(["blob"]).join(seen, "blob", "left")
    blobs = blobs.withColumn("seen", F.coalesce("seen", F.array().cast("array<string>"))).filter(F.size("seen") < len(rules))
    # a pair that the ledger holds is not scanned again
    tried = blobs.select("blob", *[F.when(~F.array_contains("seen", r.kind), _lengths(F.col("text"), r)).alias(f"m{n}") for n, r in enumerate(rules)])
    tried = written(tried.select("blob", F.explode(F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(n).alias("ord"), F.lit(r.min_len).alias("least"),
                 F.col(f"m{n}").alias("m")) for n, r in enumerate(rules)])).alias("e")).select("blob", "e.*").filter("m IS NOT NULL"), "matches")
    up_to = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spots = tried.select("blob", "kind", "version", "ord", "least", F.posexplode("m").alias("at", "x"))
    spots = spots.withColumn("stop", F.sum(F.col("x.gap") + F.col("x.hit")).over(up_to).cast("int")).filter("x.size >= least")
    spans = spots.groupBy("blob", "kind", "version").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("stop") - F.col("x.hit")).alias("start"), "stop", "ord", "kind"))).alias("spans"))
    pairs = tried.select("blob", "kind", "version").unionByName(spans.select("blob", "kind", "version", F.col("spans").alias("got")), allowMissingColumns=True)
    none = F.expr("CAST(array() AS array<struct<start:int,stop:int,ord:int,kind:string>>)")
    entries = written(pairs.groupBy("blob", "kind", "version").agg(F.coalesce(F.max("got"), none).alias("spans")), "ledger")
    found = known.unionByName(entries).filter(F.size("spans") > 0).groupBy("blob").agg(
        F.flatten(F.collect_list("spans")).alias("found")).select("blob", _ordered("found").alias("found"))
    # copies of one blob may be a third of all paths: the join's larger side is split where
    # the planner sees the skew (skew join), as the side with the findings is small
    return paths.select("doc_id", "blob").join(found, "blob", "left"), entries


def _ordered(c: str) -> Column:
    """Spans by start, then by the rule's place in the table, then by stop."""
    key = F.transform(F.col(c), lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return F.sort_array(key)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_report(paths: DataFrame) -> DataFrame:
    """Counts and digests per input row from the ``paths`` of ``scan``."""
    none = F.expr("CAST(array() AS array<struct<start:int,ord:int,stop:int,kind:string>>)")
    d = paths.withColumn("found", F.coalesce("found", none))
    kinds = [r.kind for r in BASE_RULES]

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return d.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(_joined(F.filter("found", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"))
