"""URL filters: listed policy rules first, association rules for the rest.

Listed rules ``(host, path, verdict)`` fit their host and its subdomains when the url's
path starts with the rule's path; the longest rule wins.  Where none fits, Spark's
pattern growth has mined token combinations of labelled urls; rules ``tokens -> bad`` above a
support and a confidence are matched through an inverted index (token -> rule), one join
of distinct urls' tokens with the index.  A url with a complete match is blocked, any
other is allowed.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
listed rule and has no tokens, so it is allowed; repeated rows get equal results; an
empty table gives an empty result; without labels no rule is mined; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventfeat.llm.common import ascii_lower, written

# The listed policy.
POLICY = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.substr(u, at + 3)
    return F.when(at > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.substr(u, at + 3)
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def listed_rule(host: Column, path: Column, policy=POLICY) -> Column:
    """The longest fitting rule as a struct (length, rule, verdict), or null.  The policy
    is a list written by people; it is a literal of the plan."""
    tests = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                    F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
             for h, p, v in policy]
    return F.array_max(F.array_compact(F.array(*tests)))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: host labels with their parts, the host's suffixes, and path words;
    runs of digits count as one token."""
    labels = F.filter(F.split(host, r"[.\-]"), lambda x: x != "")
    parts = F.filter(F.split(ascii_lower(path), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    number = lambda x: F.when(x.rlike(r"^[0-9]+$"), F.lit("#")).otherwise(x)
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), number(x))),
        F.transform(parts, lambda x: F.concat(F.lit("p:"), number(x)))))


def frequent_sets(rows: DataFrame, least: int, max_size: int) -> DataFrame:
    """``tokens, freq`` of the token sets of at most ``max_size`` tokens in ``least`` rows
    or more, by Spark's pattern growth.

    ``FPGrowth`` has no bound on the size of a set: 30 equal urls of 20 tokens have a
    million frequent sets.  ``PrefixSpan`` grows patterns in the same way, by projection on
    frequent items, and stops at a length; over sorted tokens, one to an element, its
    sequences of length k are the sets of k tokens."""
    from pyspark.ml.fpm import PrefixSpan

    n = rows.count()
    if n < least:
        return rows.sparkSession.createDataFrame([], "tokens array<string>, freq long")
    # PrefixSpan rounds the least count up
    miner = PrefixSpan(minSupport=(least - 0.5) / n, maxPatternLength=max_size, sequenceCol="items")
    items = rows.select(F.transform(F.array_sort(F.array_distinct("tokens")), lambda t: F.array(t)).alias("items"))
    return miner.findFrequentSequentialPatterns(items).select(F.flatten("sequence").alias("tokens"), "freq")


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, max_size: int = 3,
               min_rows: int = 20) -> DataFrame:
    """``tokens, size, support_rows, confidence`` of combinations that announce a bad
    label.  ``labelled``: ``tokens`` and boolean ``bad``.  A rule that has a shorter rule
    inside it adds nothing and is pruned."""
    labelled = written(labelled.select("tokens", "bad"), "labelled")
    n = labelled.count()
    least = max(1, min_rows, math.ceil(min_support * n))
    bad = frequent_sets(labelled.filter("bad"), least, max_size).withColumnRenamed("freq", "bad_rows")
    # a set's rows are at least its bad rows, so the same bound holds for all rows
    both = bad.join(frequent_sets(labelled, least, max_size), "tokens")
    rules = written(both.select("tokens", F.size("tokens").alias("size"), F.col("bad_rows").alias("support_rows"),
                                (F.col("bad_rows") / F.col("freq")).alias("confidence")).filter(
        F.col("confidence") >= min_confidence), "rules")
    # pruning: a rule's shorter subsets, a handful each, are looked up among the rules
    inner = F.filter(F.transform(F.sequence(F.lit(1), F.lit(2 ** max_size - 2)), lambda mask: F.filter(
        F.col("tokens"), lambda t, i: mask.bitwiseAND(F.pow(F.lit(2), i).cast("int")) > 0)),
        lambda s: (F.size(s) >= 1) & (F.size(s) < F.col("size")))
    covered = rules.select("tokens", F.explode(F.array_distinct(inner)).alias("inner")).join(
        rules.select(F.col("tokens").alias("inner")), "inner").select("tokens").distinct()
    return rules.join(covered, "tokens", "left_anti")


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
               label_id: str = "doc_id", policy=POLICY, rules: DataFrame | None = None, **mining) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per input row.  ``labels`` (id, quality,
    toxic) marks urls as bad where quality is 0 or toxic is 1; its ``label_id`` is compared
    with the pages' ids (the given tables have labels by document, and page n counts as
    document n)."""
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    d = d.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    if rules is None and labels is not None:
        marks = labels.filter(F.col(label_id).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull())).groupBy(
            F.col(label_id).alias("page_id")).agg(F.max(
                (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("bad"))
        labelled = d.join(marks, "page_id").select(url_tokens(F.col("host"), F.col("path")).alias("tokens"), "bad")
        rules = mine_rules(labelled, **mining)
    out = d.withColumn("listed", listed_rule(F.col("host"), F.col("path"), policy))
    if rules is None:
        blocked = None
        hit = F.lit(False)
    else:
        index = rules.select(F.xxhash64("tokens").alias("rule_id"), "size", F.explode("tokens").alias("token"))
        blocked = d.select("host", "path").distinct().withColumn("token", F.explode(url_tokens(F.col("host"), F.col("path")))).join(
            index, "token").groupBy("host", "path", "rule_id", "size").count().filter(
            F.col("count") == F.col("size")).select("host", "path").distinct().withColumn("hit", F.lit(True))
        out = out.join(blocked, ["host", "path"], "left")
        hit = F.coalesce(F.col("hit"), F.lit(False))
    return out.select("page_id", "host", "path", F.col("listed")["rule"].alias("rule"),
                      F.coalesce(F.col("listed")["verdict"], F.when(hit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
